"""Property checks against brute force on small random logs."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickmart.operators import features, ranking
from clickmart.schemas import LOG_SCHEMA

small = st.one_of(st.none(), st.integers(0, 3))
row = st.tuples(
    st.integers(1, 3),  # user
    small,  # item
    small,  # cat
    st.integers(1, 2),  # seller
    st.one_of(st.none(), st.sampled_from(["1110", "1111"])),  # day
    st.one_of(st.none(), st.integers(0, 3)),  # action
)
rows = st.lists(row, min_size=1, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rs):
    return spark.createDataFrame([(u, i, c, s, None, d, a) for (u, i, c, s, d, a) in rs], LOG_SCHEMA)


def _brute_features(rs):
    """The original job's semantics, computed in pandas row by row."""
    out = {}
    for (u, i, c, s, d, a) in rs:
        g = out.setdefault((u, s), {"rows": [], "items": set(), "cats": set(), "days": set()})
        g["rows"].append(a)
        g["items"].add(i)  # NULL is one more group, as in a group-by
        g["cats"].add(c)
        g["days"].add(d)
    res = {}
    for k, g in out.items():
        acts = g["rows"]
        res[k] = (
            len(acts),
            len(g["items"]),
            len(g["cats"]),
            len(g["days"]),
            sum(1 for a in acts if a != 0),  # None != 0 is a non-click
            sum(1 for a in acts if a == 1),
            sum(1 for a in acts if a == 2),
            sum(1 for a in acts if a == 3),
        )
    return res


@SETTINGS
@given(rs=rows)
def test_log_aggregate_equals_brute_force(spark, rs):
    got = {
        (r.user_id, r.merchant_id): tuple(r[f] for f in features.LOG_FEATURES)
        for r in features.log_aggregate(_df(spark, rs)).collect()
    }
    assert got == _brute_features(rs)


@SETTINGS
@given(rs=rows, k=st.integers(1, 4))
def test_top_items_equals_brute_force(spark, rs, k):
    pdf = pd.DataFrame(rs, columns=["u", "item", "c", "s", "day", "a"])
    eng = pdf[(pdf.day == "1111") & (pdf.a.map(lambda a: a != 0))]
    counts = eng.groupby("item", dropna=False).size().reset_index(name="n")
    counts["key"] = counts["item"].map(lambda x: (1, 0) if pd.isna(x) else (0, x))
    counts = counts.sort_values(["n", "key"], ascending=[False, True], key=None)
    counts = sorted(
        ((int(r.n), r.key, None if pd.isna(r.item) else int(r.item)) for r in counts.itertuples()),
        key=lambda t: (-t[0], t[1]),
    )[:k]
    want = [(rank + 1, item, n) for rank, (n, _, item) in enumerate(counts)]
    got = [(r["rank"], r.item_id, r.n) for r in ranking.top_items(_df(spark, rs), k=k).collect()]
    assert got == want


profile = st.tuples(st.integers(1, 4), st.one_of(st.none(), st.integers(0, 8)), st.one_of(st.none(), st.integers(0, 2)))
profiles = st.lists(profile, min_size=0, max_size=8)


@SETTINGS
@given(rs=rows, us=profiles, mode=st.sampled_from(["all", "complete", "any"]), attr=st.sampled_from(["age_range", "gender"]))
def test_buyer_counts_equal_brute_force(spark, rs, us, mode, attr):
    from clickmart.operators import shares
    from clickmart.schemas import USERS_SCHEMA

    keep = {
        "all": lambda a, g: True,
        "complete": lambda a, g: g is not None,
        "any": lambda a, g: a is not None or g is not None,
    }[mode]
    buyers = {u for (u, _, _, _, d, a) in rs if d == "1111" and a == 2}
    pos = 1 if attr == "age_range" else 2
    want: dict = {}
    for p in us:
        if p[0] in buyers and keep(p[1], p[2]):
            want.setdefault(p[pos], set()).add(p[0])
    want = {k: len(v) for k, v in want.items()}
    users = spark.createDataFrame(us, USERS_SCHEMA)
    got = {r[attr]: r.buy_num for r in shares.buyer_counts(_df(spark, rs), users, attr, users_mode=mode).collect()}
    assert got == want


@SETTINGS
@given(counts=st.lists(st.integers(1, 10**7), min_size=1, max_size=8))
def test_share_percent_text_is_correctly_rounded(spark, counts):
    from decimal import ROUND_HALF_EVEN, Decimal

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from clickmart.functions import format_percent, percent_of_total

    df = spark.createDataFrame(list(enumerate(counts)), "k int, buy_num long")
    total = F.sum("buy_num").over(Window.partitionBy())
    got = {r.k: r.percent for r in df.select("k", format_percent(percent_of_total("buy_num", total), 5).alias("percent")).collect()}
    t = sum(counts)
    want = {
        k: f"{Decimal(n / t * 100.0).quantize(Decimal('0.00001'), rounding=ROUND_HALF_EVEN):,.5f}"
        for k, n in enumerate(counts)
    }
    assert got == want
