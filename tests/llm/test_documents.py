"""The document operators on hard cases, against brute force in plain Python."""

import itertools
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hard_rows import BASE, EDGE, LONG, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.llm import decontamination, language_id, license_scan, line_dedup, ngram_join, pattern_packing
from clickmart.llm.common import text_slices
from clickmart.llm.encoding import PieceEncoder, default_path

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


# ------------------------------------------------------------ op 2
def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_groups(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    links = [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    root = components(range(len(rows)), links)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=key)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_groups_match_brute_force(spark, edge_docs, k, percent):
    got = ngram_join.ngram_groups(edge_docs, words=k, percent=percent)
    rows = got.select("rest.doc_id", "n_shingles", "component_id", "kept", "rest.token").collect()
    assert sorted([tuple(r[:3]) for r in rows], key=key) == brute_groups([e[:2] for e in EDGE], k, percent)
    assert {r["token"] for r in rows} == {"t"}
    whole = ngram_join.unpacked(got).collect()
    texts = [r["text"] for r in whole]
    assert texts.count(BASE) == 1 and texts.count("one two") == 1
    assert {None, "", " \n\t\r "} <= set(texts)


def test_many_near_copies_are_one_group(spark):
    # 60 variants of one text, each with its own word changed, and 60 texts that share one long passage
    words = prose(9, 200).split()
    rows = [(i, " ".join(words[:i] + [f"w{i}"] + words[i + 1 :])) for i in range(60)]
    passage = prose(10, 60)
    rows += [(100 + i, passage + " " + prose(200 + i, 5 + i)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.ngram_groups(df, words=3, percent=90).select("rest.doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_groups(rows, 3, 90)


def test_level_choice_grows_with_cost():
    cheap = ngram_join._choose_level(np.zeros(40), 200, 21, 180)
    dear = ngram_join._choose_level(np.full(40, 500.0), 200, 21, 180)
    assert cheap == 1 and dear > 1
    assert ngram_join._choose_level(np.full(4, 500.0), 1, 1, 1) == 1  # a set of one token has no longer prefix


# ------------------------------------------------------------ op 3
def brute_lines(rows, min_chars, edits):
    spans = []
    distinct = {}
    for doc, text in {r: None for r in rows}:
        if text is None:
            continue
        for number, line in enumerate(text.split("\n")):
            line = line.strip()
            if len(line) >= min_chars:
                spans.append((doc, text, number, line))
                distinct.setdefault(line, None)
    lines = list(distinct)
    near = [
        (a, b) for a, b in itertools.combinations(lines, 2)
        if abs(len(a) - len(b)) <= edits and line_dedup._plain_distance(a, b) <= edits
    ]
    root = components(lines, near)
    first, removed = {}, {}
    for doc, text, number, line in sorted(spans, key=lambda s: (s[0] is None, s[0] or 0, s[2])):
        if first.setdefault(root[line], (doc, text, number)) != (doc, text, number):
            removed.setdefault((doc, text), []).append(number)
    return sorted([(doc, removed.get((doc, text), [])) for doc, text in rows], key=key)


def variants():
    line = "the quick brown fox jumps over the lazy dog and runs home"
    out = [line[:i] + "#" + line[i + 1 :] for i in range(0, 40, 2)] + [line + "!", line[1:], line[:-2]]
    return [(300 + i, f"{v}\n{prose(400 + i, 12)}\nshort") for i, v in enumerate(out)]


def test_repeated_lines_match_brute_force(spark, edge_docs):
    rows = [e[:2] for e in EDGE if e[1] not in (LONG, EDGE[14][1])] + variants()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = line_dedup.repeated_lines(df, min_chars=20, max_edits=2).select("doc", "removed").collect()
    assert sorted([(r[0], r[1]) for r in got], key=key) == brute_lines(rows, 20, 2)


def test_only_lines_that_share_a_key_travel_as_text(spark, monkeypatch):
    sent, plain = [], line_dedup._line_texts

    def counted(*args):
        sent.append((out := plain(*args)).count())
        return out

    monkeypatch.setattr(line_dedup, "_line_texts", counted)
    rows = [(1000 + i, prose(500 + i, 12)) for i in range(300)] + variants()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    rest = len({line for _, text in rows for line in text.split("\n") if len(line) >= 32})
    got = line_dedup.repeated_lines(df).select("doc", "removed").collect()
    assert sorted([(r[0], r[1]) for r in got], key=key) == brute_lines(rows, 32, 2)
    assert len(variants()) <= sum(sent) < rest / 4


def test_crowded_line_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FILTER_BITS", 5)
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = line_dedup.repeated_lines(df, min_chars=20).select("doc", "removed").collect()
    assert sorted([(r[0], r[1]) for r in got], key=key) == brute_lines(rows, 20, 2)


def test_lines_are_cut_and_trimmed_as_python_does():
    wide = " \t" * 40
    texts = ["", "a", f"{wide}a b{wide}\n{wide}\n\n\U0001f600 é \n", None, f"x{wide}y\u2003\n", wide, "z" * 50 + wide + "\n\n"]
    for part in (texts, ["plain ascii \n only", wide + "q"], [None, ""], []):
        for lo, hi, data, offsets in text_slices(pa.array(part, pa.string())):
            chars, row, number, start, end = line_dedup._lines(data, offsets)
            got = [(r, n, chars[a:b].tobytes().decode("utf-32-le")) for r, n, a, b in zip(*(x.tolist() for x in (row, number, start, end)))]
            assert got == [(r, n, line.strip()) for r, text in enumerate(part[lo:hi]) for n, line in enumerate((text or "").split("\n"))]


def test_line_dedup_takes_effect(spark, edge_docs):
    out = line_dedup.dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns
    rows = out.collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert BASE.split("\n")[3] not in by_id[12]["text"] and prose(4, 60) in by_id[12]["text"]
    assert by_id[13]["text"].strip() == "and an end of its own with some more words" and by_id[6]["text"] == LONG
    assert 13 not in {r["doc_id"] for r in line_dedup.dedup_lines(edge_docs, bare_share=0.8).collect()}
    assert by_id[2]["text"] is None and by_id[1]["text"] == ""
    assert {r["token"] for r in rows} == {"t"}


def test_short_lines_are_grouped_by_equality(spark):
    docs = [(i, f"{prose(80 + i, 12)}\nSubscribe now!\nYes.") for i in range(6)] + [(7, "\n".join(["Was eran."] * 7)), (8, "Was here, too\nWas here, too")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc"]: r["removed"] for r in line_dedup.repeated_lines(df, own_times=line_dedup.OWN_TIMES).collect()}
    assert got == {0: []} | {i: [1] for i in range(1, 6)} | {7: [1, 2, 3, 4, 5, 6], 8: []}


def test_every_line_group_keeps_one_copy(spark):
    x, y, z, w = (prose(50 + i, 5) for i in range(4))
    base = prose(60, 240)
    docs = [
        (1, base), (2, base + "\n" + x),  # goes, and has the first x
        (3, prose(61, 120) + "\n" + x), (4, prose(62, 120) + "\n" + x), (5, "\n".join([y] * 6)),  # 5 loses 5 of 6
        (6, base + "\n" + z + "\n" + x + "\n" + w), (7, base + "\n" + z), (None, prose(63, 120) + "\n" + w),  # z is in bare documents only
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for share in (None, 0.8):
        got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(df, bare_share=share).collect()}
        left = [line for text in got.values() for line in text]
        assert all(left.count(line) == 1 for line in {line for _, text in docs for line in text.split("\n")})
        if share is None:  # only 7 has nothing of its own left
            assert set(got) == {1, 2, 3, 4, 5, 6, None} and got[2] == [x] and got[5] == [y] and got[6] == [z, w]
    assert set(got) == {1, 3, 4, 5, 6, None} and x in got[3] and got[5] == [y] and got[6] == [z] and w in got[None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abé\U0001f600 ", max_size=30), st.text("abé\U0001f600 ", max_size=30)), max_size=8), st.integers(1, 4))
def test_banded_distance(pairs, edits):
    got = line_dedup.within_edits([a for a, _ in pairs], [b for _, b in pairs], edits)
    assert got.tolist() == [line_dedup._plain_distance(a, b) <= edits for a, b in pairs]


# ------------------------------------------------------------ op 4
def test_language_edges(spark, edge_docs):
    model = language_id.train(edge_docs)
    rows = language_id.identify(edge_docs, model).select("row.doc_id", "row.row", "lang_pred", "score", "mixture").collect()
    assert len(rows) == len(EDGE) and {r["row"] for r in rows} == {1}
    for r in rows:
        unknown = r["doc_id"] in (1, 2, 3, 10)
        assert (r["lang_pred"] == "und") == unknown, r
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) != unknown
        assert r["lang_pred"] in ("und", "en", "de", "fr")


def test_language_without_training(spark, edge_docs, no_docs):
    model = language_id.train(no_docs)
    assert {r[0] for r in language_id.identify(edge_docs, model).select("lang_pred").collect()} == {"und"}
    assert language_id.identify(no_docs, model).collect() == []


def test_language_accuracy_and_mixtures(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.where(~language_id.held_out(docs["doc_id"]))
    model = language_id.train(train)
    rows = language_id.identify(docs, model).select("row.doc_id", "row.lang", "row.text", "lang_pred").collect()
    hits = [r["lang"] == r["lang_pred"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(hits) > 200 and sum(hits) / len(hits) > 0.98
    # halves of two languages are found as two
    en = next(r["text"] for r in rows if r["lang"] == "en" and len(r["text"]) > 2000)[:2000]
    de = next(r["text"] for r in rows if r["lang"] == "de" and len(r["text"]) > 2000)[:2000]
    mixed = spark.createDataFrame([(1, f"{en} {de}"), (2, en)], "doc_id long, text string")
    found = {r[0]: r[1] for r in language_id.identify(mixed, model).select("row.doc_id", "mixture").collect()}
    assert {m["lang"] for m in found[1]} == {"en", "de"} and all(0.3 < m["share"] < 0.7 for m in found[1])
    assert [m["lang"] for m in found[2]] == ["en"]


def test_penalised_selection_is_the_best_set():
    rng = np.random.default_rng(5)
    like = rng.uniform(0.01, 1, (40, 3)).astype(np.float32)
    model = language_id.MixtureModel.__new__(language_id.MixtureModel)
    share = model.infer(like, np.zeros(40, np.int64))[0]
    value = {}
    for size in (1, 2, 3):
        for names in itertools.combinations(range(3), size):
            allowed = np.zeros((1, 3))
            allowed[0, list(names)] = 1
            fit = language_id.MixtureModel.fit(like, np.zeros(40, np.int64), allowed)[1][0]
            value[names] = fit - language_id.PENALTY * np.log(41) * (size - 1)
    assert tuple(np.flatnonzero(share)) == max(value, key=value.get)


# ------------------------------------------------------------ op 6
def test_pieces_and_packing(spark, edge_docs):
    rows = pattern_packing.pack_documents(edge_docs, keep_ids=True).collect()
    enc = PieceEncoder(default_path())
    whole = {}
    for r in rows:
        assert len(r["ids"]) == r["length"] <= 1024
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        whole.setdefault(r["doc_id"], []).append(r)
    for doc, text, _ in EDGE:
        expect = [*enc.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        parts = sorted(whole[doc], key=lambda r: r["start"])
        copies = sum(e[0] == doc for e in EDGE)
        assert sum((r["ids"] for r in parts[::copies]), []) == expect
        assert len(expect) <= 1024 or all(r["length"] == 1024 for r in parts if r["piece"])
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(places) <= -(-total // 1024) + 1
    joined = {r["sequence_id"]: r["ids"] for r in pattern_packing.sequences(pattern_packing.pack_documents(edge_docs, keep_ids=True)).collect()}
    assert sum(map(len, joined.values())) == total


def test_special_strings_are_tokens_as_the_file_reads_them(spark):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(default_path())
    texts = ["<|endoftext|>", "a <|endoftext|>b", "one <|endoftext|><|endoftext|> \n two", "<|endof text|>", "\u0448 <|endoftext|>\u0448"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in pattern_packing.pack_documents(docs, keep_ids=True).collect()}
    assert got == {i: [*fresh.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert got[0] == [50256, 2]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_plan_needs_no_more_sequences_than_best_fit(lengths):
    hist = np.bincount(lengths, minlength=65)
    plain = hist.copy()
    plain[64] = 0
    best_fit = int(hist[64]) + sum(n for _, n in pattern_packing._best_fit(plain, 64))
    assert sum(n for _, n in pattern_packing.pattern_plan(hist, 64)) <= best_fit


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=200))
def test_plan_uses_every_piece_once(lengths):
    hist = np.bincount(lengths, minlength=25)
    plan = pattern_packing.pattern_plan(hist, 24)
    used = np.zeros(25, np.int64)
    for parts, n in plan:
        assert n > 0 and sum(parts) <= 24
        for v in parts:
            used[v] += n
    assert (used == hist).all()
    n = sum(n for _, n in plan)
    assert n >= -(-sum(lengths) // 24)
    code, _, _ = pattern_packing.plan_slots(plan, 24)
    assert len(set(code.tolist())) == len(code)


def test_fit_is_least_squares():
    hist = np.zeros(13)
    hist[[3, 4, 5, 8, 9]] = [7, 9, 3, 9, 7]
    patterns = pattern_packing._patterns(hist > 0, 12, 3)
    x = pattern_packing.fit_counts(patterns, hist, 3000)
    a = np.zeros((13, len(patterns)))
    for j, p in enumerate(patterns):
        for v in p[p > 0]:
            a[v, j] += 1
    gradient = a.T @ (a @ x - hist)
    assert (x >= 0).all() and gradient.min() > -1e-2 and np.abs(gradient[x > 1e-3]).max(initial=0) < 1e-2


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_cached_encoding_is_the_tokenizers(text):
    enc = test_cached_encoding_is_the_tokenizers.enc
    expect = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == expect
    assert enc.decode_all([expect]) == [text]


test_cached_encoding_is_the_tokenizers.enc = PieceEncoder(default_path())


# ------------------------------------------------------------ op 9
def words9(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_hits(docs, items, window=10):
    out = []
    for doc, text in docs:
        words, hit, found = words9(text), set(), set()
        for item, item_text in items:
            iw = words9(item_text)
            k = min(window, len(iw))
            wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
            places = [p for p in range(len(words) - k + 1) if tuple(words[p : p + k]) in wins] if k else []
            for p in places:
                hit.update(range(p, p + k))
            if places and item is not None:
                found.add(str(item))
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=key)


def test_contamination_matches_brute_force(spark, edge_docs, no_docs):
    passage = BASE.split()
    items = [
        (1, " ".join(passage[5:40])), (2, " ".join(passage[20:29])), (3, "ONE, Two"), (4, ""), (5, None), (None, " ".join(passage[60:75])),
        (6, " ".join(passage[5:40])), (7, "x"), (8, "never seen anywhere " * 4), (2, prose(3, 30)), (9, " ".join(passage[30:36] * 3)),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [e[:2] for e in EDGE if len(e[1] or "") < 100_000]
    df = edge_docs.where("doc_id is null or doc_id not in (6, 13)")
    rows, spans = decontamination.contamination(df, bench)
    got = [(r["doc"], r["n_words"], r["n_hit"], r["items"]) for r in rows.collect()]
    assert sorted(got, key=key) == brute_hits(docs, items)
    assert spans.count() > 0
    assert decontamination.contamination(no_docs, bench)[0].collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontamination.contamination(df, none)[0].collect()} == {0}


# ------------------------------------------------------------ op 10
def test_license_edges(spark, edge_docs, no_docs):
    rows, matches = license_scan.scan_blocks(edge_docs)
    rows = {r["doc"]: r for r in rows.collect()}
    assert rows[2]["n_words"] == 0 and rows[1]["n_words"] == 0 and rows[6]["n_words"] == 30_000
    mit = rows[11]
    assert (mit["n_words"], mit["places"][0]["n"], mit["places"][0]["first"], mit["places"][0]["last"]) == (15, 3, 3, 11)
    assert {m["label"] for m in matches.collect() if m["doc"] == 11} == {"mit"}
    assert license_scan.scan_blocks(no_docs)[0].collect() == []


def test_license_blocks_match_brute_force(spark):
    near = []
    for i, (text, _) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        for drop in range(0, len(words), 2):
            near.append((100 * i + drop, "Intro\n" + " ".join(words[:drop] + ["other"] + words[drop + 2 :]) + "\nend"))
    df = spark.createDataFrame(near, "doc_id long, text string")
    got = {(m["doc"], m["line"], m["template"]) for m in license_scan.scan_blocks(df)[1].collect()}
    expect = set()
    for doc, text in near:
        for n, line in enumerate(text.split("\n")):
            block = set(words9(line))
            for t, (template, _) in enumerate(license_scan.TEMPLATES):
                ws = set(license_scan._tokens(template))
                if len(block & ws) >= license_scan._need(len(ws), license_scan.THRESHOLD):
                    expect.add((doc, n, t))
    assert got == expect and len(expect) > 20


def labels_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [{f["label"] for f in r["found"]} for r in license_scan.scan_blocks(df)[0].orderBy("doc").collect()]


def test_license_is_told_by_its_deciding_words(spark):
    work = "This work is licensed under"
    cases = {
        "Licensed under CC BY 4.0": {"cc-by"}, "Licensed under CC BY-SA 4.0": {"cc-by-sa"}, "Licensed under CC BY-NC 4.0": {"cc-by-nc"},
        "Licensed under CC BY-NC-SA 4.0": {"cc-by-nc-sa"},
        f"{work} a Creative Commons Attribution 4.0 International License": {"cc-by"},
        f"{work} a Creative Commons Attribution-ShareAlike 4.0 International License.": {"cc-by-sa"},
        f"{work} a Creative Commons Attribution-NonCommercial 4.0 International License.": {"cc-by-nc"},
        f"{work} the GNU General Public License, version 2": {"gpl-2"}, f"{work} the GNU General Public License, version 3": {"gpl-3"},
        f"{work} the GNU Lesser General Public License, version 3": {"lgpl"},
        "Released under the BSD License": {"bsd"}, "Released under the MIT License": {"mit"},
        "This Source Code Form is subject to the terms of the Eclipse Public License": set(),
        "Text: licensed under CC BY-NC 4.0. Pictures: licensed under CC BY-SA 4.0.": {"cc-by-nc", "cc-by-sa"},
        "Released " + "in one long line " * 9 + "under a roof " + "far off " * 9 + "the MIT campus " + "and more " * 9 + "with a license": set(),
    }
    assert dict(zip(cases, labels_of(spark, cases))) == cases


def test_wrapped_license_notices(spark):
    mit, gpl, bsd = (license_scan.TEMPLATES[i][0] for i in (1, 7, 8))
    lead = prose(5, 300) + "\n"
    wrapped = [lead + textwrap.fill(t, 40, initial_indent=mark, subsequent_indent=mark) + "\n" + prose(6, 90) for t in (mit, gpl, bsd) for mark in ("", " * ", "# ")]
    assert labels_of(spark, wrapped) == [{x} for x in ("mit", "gpl", "bsd") for _ in range(3)]
    # wherever a notice begins, it lies in one block whole
    moved = [prose(7, n) + "\n" + textwrap.fill(gpl, 30) + "\n" + prose(8, 50) for n in range(1, 100, 7)]
    assert labels_of(spark, moved) == [{"gpl"}] * len(moved)


def test_labels_do_not_depend_on_what_stands_in_front(spark):
    # prose of any length moves the notice over the blocks; template words in front open windows that end within it
    fronts = ["", "the ", "this work is ", "under the ", "is under the terms of the public ", "work is licensed ", "a 4 0 international "]
    places = [prose(500 + n, n).replace("\n", " ") + " " + front for n in range(3, 143, 7) for front in fronts]
    gpl = [p + "This work is licensed under the GNU General Public License, version 3." for p in places]
    nc = [p + "Licensed under CC BY-NC 4.0" + (" and then some" if i % 2 else "") for i, p in enumerate(places)]
    assert labels_of(spark, gpl + nc) == [{"gpl-3"}] * len(gpl) + [{"cc-by-nc"}] * len(nc)


def test_versions_displace_the_name_alone(spark):
    fsf = "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
    texts = [
        fsf, fsf + ", either version 3 of the License", fsf + "; version 2", fsf + " " + prose(4, 12) + " version 3",
        "This work is licensed under version 3 of the GNU General Public License",
    ]
    assert labels_of(spark, texts) == [{"gpl"}, {"gpl-3"}, {"gpl-2"}, {"gpl"}, {"gpl-3"}]
