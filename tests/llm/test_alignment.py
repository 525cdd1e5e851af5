"""Token alignment against a byte-by-byte version with fresh tokenizers."""

import bisect
import hashlib
from collections import Counter

import numpy as np
import pytest
from hard_rows import EDGE, LONG, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.llm import token_alignment as ta


@pytest.fixture(scope="module")
def fresh():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    # the byte alphabet from the vocabulary itself: its first 256 entries are the bytes in the order of the alphabet
    order = [*range(33, 127), *range(161, 173), *range(174, 256)]
    order += [i for i in range(256) if i not in order]
    of = {a.id_to_token(i): byte for i, byte in enumerate(order)}

    def a_bytes(i):
        return bytes(of[c] for c in a.id_to_token(i))

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        want = (" " + text).encode()
        x = [(i, a_bytes(i)) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, b_bytes(i)) for i in b.encode(text)]
        return (x, y) if b"".join(t for _, t in x) == want == b"".join(t for _, t in y) else None

    return tokens


def brute(texts, tokens):
    docs, counts = [], Counter()
    for text in texts:
        both = tokens(text)
        if both is None:
            docs.append(None)
            continue
        ends = []
        for side in both:
            at, found = 0, {}
            for i, data in side:
                at += len(data)
                found[at] = i
            ends.append(found)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        texts_of = []
        for side in ends:
            held = {c: [] for c in cuts}
            for e in side:
                held[cuts[bisect.bisect_left(cuts, e)]].append(str(side[e]))
            texts_of.append([",".join(held[c]) for c in cuts])
        parts = [f"{x}|{y}" for x, y in zip(*texts_of)]
        counts.update(links)
        docs.append((len(both[0]), len(both[1]), len(cuts), links, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if d is None
        else (*d[:3], len(d[3]), sum(counts[x] == most[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), d[4])
        for d in docs
    ]


HARD = [
    "<|endoftext|> and <s> x </s> <unk> [INST]", "line\nline\n\n  two  spaces \n ", " leading", "\t\ttabs   nbsp\r\nend", "▁ lower one eighth block",
    "漢字かな交じり文 and 한국어 🙂🙃 👩‍👩‍👧", "é é ﬁ ½ ​﻿", " ", "\n", "a" * 3000, "…" * 700, "'s 't I'll 12345678901234567890",
]


@pytest.mark.parametrize("lookup", [1 << 20, 40, 0])
def test_documents_match_brute_force(spark, fresh, lookup):
    # nulls, empty and very long texts, repeated rows, special strings, texts that B cannot give back
    texts = [t for _, t, _ in EDGE] + HARD
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, codes string").repartition(3)
    got = ta.align_documents(df, lookup=lookup).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, fresh)
    assert sum(r.n_a > 0 for r in got) > 20 and got[len(EDGE) + 4].n_a == 0


def test_empty_table(spark, no_docs):
    assert ta.align_documents(no_docs).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "the", "The", "é", "日", "🙂", "<s>", "'s", "12", ".", " ", "\r\n", "́"]), max_size=30))
def test_units_give_whole_encodings(parts):
    both = ta.token_pair(*ta.default_paths())
    assert both.b.by_unit
    text = "".join(parts)
    if text:
        assert both.b.encode(text).tolist() == both.b.model.encode(text)


def test_units_of_prose():
    both = ta.token_pair(*ta.default_paths())
    for text in [prose(7, 3000), LONG[:20_000], *[h for h in HARD if h]]:
        assert both.b.encode(text).tolist() == both.b.model.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=8), st.lists(st.integers(1, 4), min_size=1, max_size=8)), min_size=1, max_size=4))
def test_intervals(cases):
    # sizes stand for ids; both sides are cut to cover the same bytes
    size = np.arange(9)
    pairs = []
    for a, b in cases:
        d = sum(a) - sum(b)
        a, b = (a, b + [1] * d) if d > 0 else (a + [1] * -d, b)
        pairs.append((np.array(a, np.int32), np.array(b, np.int32)))
    got = ta.align(pairs, size, size)
    links, groups = [], []
    expanded = set()
    for k, (a, b) in enumerate(pairs):
        x, y = np.cumsum(a), np.cumsum(b)
        common = sorted(set(x) & set(y))
        groups.append(len(common))
        links += [(k, int(a[list(x).index(c)]), int(b[list(y).index(c)])) for c in common]
        expanded |= {(k, i, j) for i in range(len(a)) for j in range(len(b)) if x[i] - a[i] < y[j] and y[j] - b[j] < x[i]}
    at = got["link"]
    assert got["n_groups"].tolist() == groups and len(got["a"]) == len(expanded)
    assert list(zip(got["doc"][at].tolist(), got["a"][at].tolist(), got["b"][at].tolist())) == links


def test_a_text_of_known_words_is_not_compared_again(monkeypatch):
    both = ta.TokenPair(*ta.default_paths())
    text, odd = "plain words\n  and 12 more, caf\u00e9", "plain \u2581 words"
    first = [x.tolist() for x in both.encode(text)]
    assert all(first) and [len(x) for x in both.encode(odd)] == [0, 0]
    calls, spells = [], ta.spells
    monkeypatch.setattr(ta, "spells", lambda ids, table, t: calls.append(t) or spells(ids, table, t))
    assert [x.tolist() for x in both.encode(text)] == first and not calls
    assert [len(x) for x in both.encode(odd)] == [0, 0] and len(calls) == 1  # its odd word is remembered
