"""Embeddings, pages and conversations: hard cases against brute force in plain Python."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.llm import cap_filters, chat_assembly, html_extraction, url_filter


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


# ------------------------------------------------------------ op 1
def brute_links(rows, threshold=0.9):
    units = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v) / max(map(abs, v)) if ok else None)
        if ok:
            units[-1] /= np.linalg.norm(units[-1])
    n = len(rows)
    near = [[] for _ in rows]
    for i, j in itertools.combinations(range(n), 2):
        a, b = units[i], units[j]
        if a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold:
            near[i].append(j)
            near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return sorted(out, key=key)


def near_rows(d, groups, size, seed, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(d)
        for _ in range(size):
            rows.append((len(rows), (centre + spread * rng.standard_normal(d)).tolist()))
    return rows


SCHEMA1 = "vec_id long, embedding array<double>, id long, key string, dim int, mult int"


def links_of(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA1)
    got = cap_filters.near_duplicates(df, **options).select("vec_id", "n_links", "component_id").collect()
    return sorted(map(tuple, got), key=key)


def test_vector_edges(spark):
    rows = near_rows(16, 12, 5, 1, 0.25)
    base = rows[0][1]
    rows += [
        (100, None), (101, []), (102, [0.0] * 16), (103, [float("nan")] + [1.0] * 15), (104, [float("inf")] + [1.0] * 15),
        (105, [None] + [1.0] * 15), (106, base), (106, base), (None, base), (107, [2 * x for x in base]), (108, [1.0, 2.0]), (109, [1.0, 2.1]),
        (110, [3.0]), (111, [5.0]), (112, [-5.0]), (113, [1e300] * 16), (114, [1e-300] * 16),
    ]
    assert links_of(spark, rows) == brute_links(rows)


def test_hot_filter_is_cut_into_chunks(spark):
    rows = near_rows(24, 3, 90, 2, 0.2)
    assert links_of(spark, rows, chunk=16) == brute_links(rows)


def test_no_vectors(spark):
    assert links_of(spark, []) == []


def test_recall_at_the_threshold(spark):
    # pairs just above the threshold, the hardest to find
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.901 * a + math.sqrt(1 - 0.901**2) * b).tolist())]
    found = sum(n > 0 for _, n, _ in links_of(spark, rows))
    assert found / len(rows) >= 0.99


def test_decoding_is_complete():
    code = cap_filters.CapCode(12, 3000, 0.9)
    unit = cap_filters._unit(np.random.default_rng(1).standard_normal((20, 12)))
    grid = list(itertools.product(range(code.size), repeat=code.blocks))
    score = np.hstack([
        (unit @ rotation) @ np.array([np.concatenate([c[j] for c, j in zip(words, g)]) for g in grid]).T / math.sqrt(code.blocks)
        for rotation, words in code.codes
    ])
    for row, found in zip(score, code.decode(unit)):
        assert set(np.flatnonzero(row >= code.alpha + 1e-9)) <= set(found.tolist()) <= set(np.flatnonzero(row >= code.alpha - 1e-9))


# ------------------------------------------------------------ op 5
def test_rules_and_edges(spark):
    cases = {
        None: ("", "", None), "no scheme": ("", "", None), "http://": ("", "", None),
        "http://EXAMPLE.net/en/x?q#f": ("example.net", "/en/x", "example.net/en/"),
        "http://a.example.net/EN/x": ("a.example.net", "/EN/x", "net/"),
        "http://notexample.com/de/x": ("notexample.com", "/de/x", None),
        "http://m.example.com/de/": ("m.example.com", "/de/", "example.com/de/"),
        "http://x.org/fr/1://y/": ("x.org", "/fr/1://y/", "org/fr/"),
        "http://net": ("net", "", None), "http://net/": ("net", "/", "net/"),
        "a://b?c/d": ("b", "", None), "x\n://H\u00c9/p#": ("h\u00c9", "/p", None),
    }
    rows = [(i, u, "x", "y") for i, u in enumerate(cases)] + [(0, None, "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, address string")
    got = url_filter.judge_urls(df).collect()
    assert len(got) == len(rows)
    by_id = {r["id"]: r for r in got}
    for (_, (host, path, rule)), r in zip(cases.items(), (by_id[i] for i in range(len(cases)))):
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == ("block" if rule in ("net/", "example.com/de/") else "allow")  # nothing rejected to learn from


def brute_ratio(train, address, order):
    """Witten-Bell interpolation straight from its definition."""

    def prob(texts, ctx, c):
        if ctx is None:
            return 1 / url_filter.ALPHABET
        lower = prob(texts, ctx[1:] if ctx else None, c)
        seen = [x[i + len(ctx)] for x in texts for i in range(order - len(ctx), len(x) - len(ctx)) if x[i : i + len(ctx)] == ctx]
        return lower if not seen else (seen.count(c) + len(set(seen)) * lower) / (len(seen) + len(set(seen)))

    def pad(x):
        return "\u0002" * order + x + "\u0003"

    text, total = pad(address), 0.0
    for i in range(order, len(text)):
        rej, acc = ([pad(x) for x in train[v]] for v in (1, 0))
        total += math.log(prob(rej, text[i - order : i], text[i])) - math.log(prob(acc, text[i - order : i], text[i]))
    return total / (len(address) + 1)


def test_scores_match_the_definition(spark):
    hosts = [f"site{c}.example.com" for c in "abcdefghijkl"] + [f"casino-{c}.example.com" for c in "abcdefgh"]
    urls = [(i, f"http://{h}/en/{i % 3}") for i, h in enumerate(hosts)]
    got = url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), order=2).collect()
    train = {0: set(), 1: set()}
    for _, u in urls:
        address = "".join("0" if c.isdigit() else c for c in u.removeprefix("http://"))
        train[int("casino" in address)].add(address)
    assert {r["label"] for r in got if "casino" in r["host"]} == {1}
    suspects = {"".join("0" if c.isdigit() else c for c in r["host"] + r["path"]) for r in got if r["label"] is None}
    train[0] -= suspects
    assert train[0] and train[1]
    for r in got:
        address = "".join("0" if c.isdigit() else c for c in r["host"] + r["path"])
        assert r["score"] == pytest.approx(brute_ratio(train, address, 2), abs=1e-9)


def test_unwanted_hosts_are_blocked(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [r for r in url_filter.judge_urls(pages).collect() if r["rule"] is None]
    bad = [r for r in rows if "-" in r["host"]]
    assert bad and all(r["verdict"] == "block" for r in bad)
    good = [r for r in rows if "-" not in r["host"]]
    assert sum(r["verdict"] == "allow" for r in good) >= 0.98 * len(good)


def withheld(spark, *words):
    """Verdicts of the unruled pages of sf0.1: hosts with a withheld seed word, with another one, and clean hosts."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    seeds = tuple(w for w in url_filter.REJECT_WORDS if w not in words)
    out = {"withheld": [], "seed": [], "clean": []}
    for r in url_filter.judge_urls(pages, reject_words=seeds).where("rule is null").select("host", "verdict", "label").collect():
        parts = r["host"].replace("-", ".").split(".")
        out["withheld" if set(parts) & set(words) else "seed" if set(parts) & set(seeds) else "clean"].append(r)
    return out


@pytest.mark.parametrize("words", [("casino",), ("spam",), ("cheap", "pills", "pill")])
def test_hosts_without_a_known_seed_are_judged_by_likeness(spark, words):
    got = withheld(spark, *words)
    assert len(got["withheld"]) >= 15 and len(got["clean"]) >= 1000
    assert all(r["label"] is None for r in got["withheld"])  # suspects train nothing
    assert sum(r["verdict"] == "block" for r in got["withheld"]) >= 0.85 * len(got["withheld"])
    assert all(r["verdict"] == "block" for r in got["seed"])
    assert sum(r["verdict"] == "allow" for r in got["clean"]) >= 0.99 * len(got["clean"])


def test_given_labels_train_instead_of_seeds(spark):
    hosts = [f"{w}{c}.example.com" for w in ("news", "junk") for c in "abcdefgh"] + ["casino.example.com"]
    urls = spark.createDataFrame([(i, f"http://{h}/p/{i}") for i, h in enumerate(hosts)], "page_id long, url string")
    labels = [(f"https://{w}{c}.example.com/q/{n}", w == "junk") for w in ("news", "junk") for c in "abcd" for n in "xyz"]
    labels += [("http://junka.example.com/p/8", True), ("http://junka.example.com/p/8", False), ("http://newsa.example.com/p/0", None)]
    got = url_filter.judge_urls(urls, labels=spark.createDataFrame(labels, "url string, rejected boolean")).collect()
    assert len(got) == len(hosts)
    assert {r["host"]: r["label"] for r in got if r["label"] is not None} == {"junka.example.com": 1}
    for r in got:
        if not r["host"].startswith("casino"):  # no label speaks of it
            assert r["verdict"] == ("block" if r["host"].startswith("junk") else "allow"), r


def test_empty_table_and_a_very_long_address(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
    long = "http://a.example.com/" + "x/" * 100_000
    (r,) = url_filter.judge_urls(spark.createDataFrame([(1, long)], "page_id long, url string")).collect()
    assert (r["host"], len(r["path"]), r["verdict"]) == ("a.example.com", 200_001, "allow")


# ------------------------------------------------------------ op 7
RUSSIAN = (
    "\u0413\u043e\u0440\u043e\u0434 \u0441\u0442\u043e\u0438\u0442 \u043d\u0430 \u0431\u0435\u0440\u0435\u0433\u0443 \u0440\u0435\u043a\u0438, "
    "\u0438 \u043a\u0430\u0436\u0434\u043e\u0435 \u0443\u0442\u0440\u043e \u043b\u043e\u0434\u043a\u0438 \u0432\u044b\u0445\u043e\u0434\u044f\u0442 \u0432 \u043c\u043e\u0440\u0435. "
) * 4
TAGALOG = (
    "Ang lungsod ay nasa tabi ng ilog at tuwing umaga ay lumalabas ang mga bangka patungo sa dagat upang manghuli ng isda, "
    "habang ang mga bata ay naglalaro malapit sa pampang hanggang sa sumikat nang mataas ang araw sa ibabaw ng mga bundok. "
)


@pytest.mark.parametrize("words", [RUSSIAN, TAGALOG])
def test_unmarked_pages_in_other_languages(words):
    one, two = words.strip(), " ".join(reversed(words.split()))
    page = (
        f"<html><body><nav><a href=/>Home</a></nav><div><a href=a>{words[:90]}</a> <a href=b>{words[:90]}</a></div>"
        f"<h1>{words[:30]}</h1><p>{one}</p><p>{two}</p><div class=footer>{words}</div></body></html>"
    )
    assert html_extraction.main_text(page) == "\n".join([words[:30].strip(), one, two])


def test_pages_edges(spark):
    schema = "page_id long, url string, html string, text string, page string"
    assert html_extraction.extract(spark.createDataFrame([], schema)).count() == 0
    sentence = "This is the sentence that stands in the article and it is one of many. "
    long = f"<nav>{sentence}</nav><p>{sentence * 20000}</p><script>{'x' * 100000}</script>"
    rows = [(1, "u", None, "t", "p"), (1, "u", "", "t", "p"), (2, None, long, None, None), (2, None, long, None, None)]
    got = sorted(r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, schema)).select("text").collect())
    assert got == ["", "", *[(sentence * 20000).strip()] * 2]


def test_main_text_of_hard_pages():
    article = "<p>The first part of the story is about how it was made, and what it was for, in the words of those who did it.</p>"
    text = "The first part of the story is about how it was made, and what it was for, in the words of those who did it."
    main = html_extraction.main_text
    assert main(None) == "" and main("") == "" and main("just words") == "just words"
    page = (
        "<body class='sidebar'><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><aside>More</aside>"
        f"<div class='cookie-notice'>We use cookies</div><article><h2>T &amp; <i>U</i></h2>{article}<p>Short&nbsp;\n one.<br>more"
        f"<form><label>Mail</label><input></form><div id=ad-1>Buy<div>now</div></div><script>if (a<b) '</p>'</script>"
        f"<section id=comments><article class=comment><p>{text}</p></article></section></article><footer>&copy; me</footer>"
    )
    assert main(page) == f"T & U\n{text}\nShort one. more"
    # not closed: a menu, then the article
    assert main(f"<nav><a href=1>x</a><article>{article}") == text
    # without an article the rules decide alone
    assert main(f"<div><a href=1>Go here</a> <a href=2>or there</a></div><div>{article}</div><p>End.</p>") == f"{text}\nEnd."
    assert main("<p>a<!-- b --> c <![CDATA[d]]> <p title='x>y'>e &lt;b&gt; &am") == "a c\ne <b> &am"


@settings(max_examples=150, deadline=None)
@given(st.text("<>/a p='\"&;!-\n", max_size=80))
def test_any_markup_is_read(page):
    out = html_extraction.main_text(page)
    assert out == "\n".join(" ".join(line.split()) for line in out.split("\n"))


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("*", "'x' as text", "1 as row")
    rows = html_extraction.extract(pages, with_blocks=True).select("row.page_id", "row.text", "text", "blocks").collect()
    assert len(rows) == 250
    for r in rows:
        assert r[1] == "x" and r["blocks"]
        assert not any(b["kept"] for b in r["blocks"] if b["text"].startswith("\u00a9"))
        assert r[2] == "\n".join(b["text"] for b in r["blocks"] if b["kept"]) != ""


# ------------------------------------------------------------ op 8
CHAT = "conv_id long, turn long, role string, text string, ids int, conv string"
ROWS = [
    (1, 0, "user", "hi </s>"), (1, 1, "assistant", "a\\b <|end|> [INST] \\"), (1, 1, "assistant", None), (1, None, "system", "first"),
    (2, 5, None, ""), (None, 0, "assistant", "\u00e9\U0001f600<\\/s>"), (None, 1, "<|body|>", "x"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"),
    (4, 0, "user", "word " * 20_000),
]


def chat_frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 7, "c") for r in rows], CHAT).repartition(3)


def test_round_trip_of_hard_turns(spark):
    got = {r["conv_id"]: r for r in chat_assembly.read_back(chat_assembly.format_turns(chat_frame(spark))).collect()}
    assert len(got) == 5
    for conv, r in got.items():
        turns = sorted([x for x in ROWS if x[0] == conv], key=lambda x: key(x[1:]) if x[1] is not None else ((False, -1),))
        turns = sorted(turns, key=lambda x: [(v is not None, v if v is not None else 0) for v in x[1:]])
        whole = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in turns)
        loss = "".join(text or "" for _, _, role, text in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_masks_offsets_and_no_injection(spark):
    turns = chat_assembly.with_offsets(chat_assembly.format_turns(chat_frame(spark))).collect()
    assert len(turns) == len(ROWS)
    ends = {}
    order = lambda t: [(t[c] is not None, t[c] if t[c] is not None else 0) for c in ("turn", "role", "text")]
    for t in sorted(turns, key=order):
        assert t["token_start"] == ends.get(t["conv"], 0) or t["conv"] == 3
        ends[t["conv"]] = ends.get(t["conv"], 0) + t["n_tokens"]
        assert len(t["ids"]) == len(t["loss_mask"]) == t["n_tokens"]
        assert [i for i in t["ids"] if i >= 50257] == [50257, 50258, 50259]
        assert any(t["loss_mask"]) == (t["role"] == "assistant")
        assert all(t["formatted"].count(m) == 1 for m in chat_assembly.MARKS)
    assert chat_assembly.read_back(chat_assembly.format_turns(chat_frame(spark, []))).collect() == []


def test_a_conversation_with_most_rows_is_decoded_in_many_tasks(spark):
    from pyspark.sql import functions as F

    rows = [(9, i, ("user", "assistant")[i % 2], f"turn {i} </s>\\") for i in range(2000)] + [(i, 0, "user", "x") for i in range(9)]
    frame = chat_frame(spark, rows).repartition(8)
    decoded = chat_assembly.decode_turns(chat_assembly.format_turns(frame))
    tasks = decoded.where("conv = 9").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 8
    back = {(r["conv"], r["turn"]): (r["role"], r["text"], r["trained"]) for r in decoded.collect()}
    assert back == {(c, t): (role, text, role == "assistant") for c, t, role, text in rows}
    (r,) = chat_assembly.read_back(chat_assembly.format_turns(frame)).where("conv_id = 9").collect()
    whole = "".join(f"{role}\n{text}\n" for c, _, role, text in rows if c == 9)
    assert (r["n_turns"], r["turns_sha256"]) == (2000, hashlib.sha256(whole.encode()).hexdigest())


def test_read_back_refuses_what_is_not_a_turn(spark):
    from pyspark.sql import functions as F

    turns = chat_assembly.format_turns(chat_frame(spark, ROWS[:2]))
    for wrong in (
        turns.withColumn("ids", F.slice("ids", 2, 1000)),
        turns.withColumn("loss_mask", F.transform("ids", lambda i: i == F.element_at("ids", 2))),
    ):
        with pytest.raises(Exception, match="not a turn"):
            chat_assembly.read_back(wrong).collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*chat_assembly.CONTROL, "\\", "<", "|", ">", "/", "[", "s", "x", "\n"]), max_size=12).map("".join))
def test_escapes_are_reversible(text):
    hidden = chat_assembly.escape(text)
    assert chat_assembly.unescape(hidden) == text
    assert not any(c in hidden for c in chat_assembly.CONTROL)
