import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from compare import differences, oracle  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.llm import preference as pf  # noqa: E402

TURNS = "array<struct<role:string,text:string>>"


def render(turns):
    out, mask = "", []
    for role, text in turns:
        out += f"<|im_start|>{role}\n"
        start = len(out)
        out += text.replace("<|", "< |") + "<|im_end|>\n"
        if role == "assistant":
            mask.append([start, len(out)])
    return out, mask


def by_hand(chosen, rejected):
    chosen, rejected = chosen or [], rejected or []
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    a, b = render(chosen[n:]), render(rejected[n:])
    return (n, render(chosen[:n])[0], *a, *b, bool(a[1] and b[1]))


def test_pairs_by_hand(spark):
    u, a, s = ("user", "Hi <|im_end|>"), ("assistant", "Hello 🙂"), ("system", "Be kind")
    pairs = [
        ([s, u, a], [s, u, ("assistant", "No")]),
        ([u, a, u, a], [u, a]),
        ([u, a], [u, a]),
        ([u, a], [("user", "Other"), a, u, ("assistant", "")]),
        ([], [u, a]),
        (None, None),
        ([u, a, ("user", "x" * 5000)], [u, ("user", "y"), a]),
    ]
    df = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(pairs)], f"i int, chosen {TURNS}, rejected {TURNS}"
    ).withColumn("preference", F.lit(0))
    for r in pf.formatted(df).collect():
        p = r.preference
        got = (p["n_common"], p["prompt"], p["chosen"], p["chosen_mask"], p["rejected"],
               p["rejected_mask"], p["usable"])
        assert got == by_hand(*pairs[r.i])
    assert pf.formatted(df.limit(0)).count() == 0


def test_awkward_conversations_are_those_of_sql(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "r"), (1, 1, "assistant", "r"),
        (2, 0, "user", None), (2, 1, "assistant", None), (2, 2, "user", "more"),
        (3, 0, None, "lone"),
        (4, 0, "assistant", "r"), (4, 0, "assistant", "s"), (4, None, "user", "early"),
        (5, 0, "user", "q"), (5, 1, "assistant", "r"),
        (6, 0, "user", "q"), (6, 1, "assistant", "r"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema)
    import duckdb

    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    want = con.execute(pf.OP6_SQL.replace("ORDER BY turn, role", "ORDER BY turn NULLS FIRST, role"))
    names = [d[0] for d in want.description]
    made = pf.formatted(pf.exchanged_replies(df))
    got = {r.conv_id: r.preference for r in made.collect()}
    for row in want.fetchall():
        w = dict(zip(names, row))
        p = got[w["conv_id"]]
        assert all(p[k] == w[k] for k in ("n_common", "prompt", "chosen", "rejected", "usable")), w
    assert len(got) == 6
    no_id = df.withColumn("conv_id", F.lit(None).cast("long"))
    assert pf.formatted(pf.exchanged_replies(no_id)).count() == 1
    assert pf.exchanged_replies(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    df = pf.op6_preference(spark, sf)
    assert differences(df, df.collect(), oracle(sf), pf.OP6_SQL) is None
