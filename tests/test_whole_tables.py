"""Queries that return all rows of their tables, against brute force in Python."""

import hashlib
import re

from tallyframe import catalog

SF = "/root/testdata/sf0.001"


def md5(t):
    return hashlib.md5(t.encode()).hexdigest()


def test_text_clean_keeps_runs_of_marks(spark):
    """Documents with runs of . ! ? are there, each run as its last mark."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {}
    for r in rows:
        t = r.text or ""
        plain = re.sub(" +", " ", re.sub(r" *\n[ \t\n\x0b\f\r]*", "\n", re.sub(r"[^\x20-\x7E\n]", " ", t))).strip(" ")
        told = re.sub(r"([.!?]){2,}", r"\1", re.sub(r"[ \t\n\x0b\f\r]+", " ", t.strip(" ")))
        want[r.doc_id] = (md5(plain), md5(told))
    assert any(re.search("[.!?]{2,}", r.text or "") for r in rows)
    got = catalog.QUERIES["text_clean"](spark, SF).collect()
    assert len(got) == len(rows) and {r.doc_id: (r.ascii_md5, r.described_md5) for r in got} == want


def clock(t):
    """The seconds of a clock, and its text with one place by Python's own rounding."""
    if t is None or t == "bad":
        return None, None
    m, s = re.fullmatch(r"(?:PT)?(\d+)[M:]([\d.]+)S?", t).groups()
    total = float(m) * 60 + float(s)
    left = total % 60
    return total, f"{int(total // 60)}:" + (f"{int(left):02d}" if left == int(left) else f"{left:04.1f}")


def test_clock_normalize_keeps_hundredths(spark):
    from tallyframe.plans import adapters

    want = {r.event_idx: clock(r.time_remaining) for r in adapters.events(spark, SF).select("event_idx", "time_remaining").collect()}
    got = catalog.QUERIES["clock_normalize"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/events.parquet").count()
    assert {r.event_idx: (r.seconds, r.normalized) for r in got} == want


def test_clock_rounding(spark):
    """Every hundredth of a minute, and thousandths beside the ties, as Python prints them."""
    from pyspark.sql import functions as F

    from tallyframe.functions.clock import normalize_clock

    texts = [f"{m}:{s // 100:02d}.{s % 100:02d}" for m in (0, 1, 11) for s in range(6000)] + [f"{m}:{s:02d}.{f}" for m in (0, 7) for s in (0, 9, 59) for f in ("001", "049", "051", "249", "251", "949", "951", "999")]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_clock(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [clock(r.t)[1] for r in got]


def test_derivable_tables_takes_every_event(spark):
    """Every user's day of the table is there, with what its own events allow."""
    needs = {"view": {"activity", "opening"}, "click": {"activity"}, "purchase": {"funnel"}, "error": {"health"}, "signup": {"opening"}}
    want = {}
    for r in spark.read.parquet(f"{SF}/events.parquet").collect():
        want.setdefault(f"{r.user_id}-{r.ts.day}", set()).update(needs[r.event_type])
    got = {r.game_id: r.tables for r in catalog.QUERIES["derivable_tables"](spark, SF).collect()}
    assert got == {k: ",".join(sorted(v)) for k, v in want.items()} and len(set(got.values())) > 3


def test_derivable_tables_of_unknown_sources(spark):
    from tallyframe.operators import seasons

    sources = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None)], "game_id int, source string")
    needs = spark.createDataFrame([("t", "a"), ("u", "b"), ("t", "b"), ("v", None)], "table string, source string")
    assert {tuple(r) for r in seasons.derivable_tables(sources, needs).collect()} == {(1, "t,u"), (2, ""), (3, "")}


def test_rows_of_result_sets(spark):
    """Payloads are parsed once, and what is generated for the widest set is small enough to be compiled by the JVM (8,000 bytes)."""
    import contextlib
    import io
    import re

    from tallyframe.sources import result_sets, silver

    body = '{"resultSets":[{"name":"S","headers":["B","A","A"],"rowSet":[["1","x","y"],["2"],null,["z","w",null,"v"]]},{"name":"S","headers":[],"rowSet":[["9"]]}]}'
    p = spark.createDataFrame([(1, body), (2, body.replace("resultSets", "ResultSets")), (3, "no"), (4, None), (5, '{"resultSets":[{"name":"S","headers":null,"rowSet":[["1"]]}]}'), (6, '{"resultSets":[{"name":"S","headers":["A"],"rowSet":null}]}')], "k int, body string")
    got = sorted(tuple(r) for r in result_sets.rows(p, "body", "S", {"A": "string", "B": "int", "C": "int"}).collect())
    each = [(0, "x", 1, None), (1, None, 2, None), (2, None, None, None), (3, "w", None, None)]
    assert got == [(k, *e) for k in (1, 2) for e in each] + [(5, 0, None, None, None)]
    assert sorted(r.ordinal for r in result_sets.rows(p.where("k = 1"), "body", "S", {"A": "string"}, strict=True).collect()) == [0]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for entity in silver.ENTITIES:
            said, out = io.StringIO(), silver.project(spark.read.schema("game_id string, body string").parquet("/root/testdata/sf0.001/nation.parquet"), entity)
            with contextlib.redirect_stdout(said):
                out.explain(mode="codegen")
            assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())) < 8000
            assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_payloads_move_as_columns(spark):
    """What a payload's rows are moved with is the columns of their table, in one exchange; texts are made after it."""
    for name in ("silver_pbp", "silver_shots", "resultset_shots"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.rindex("Exchange "):]
        assert "FileScan" in below and "CASE WHEN" not in below and "concat(" not in below and "array(" not in below
        assert plan.count("Exchange ") == (2 if name == "resultset_shots" else 1)


def test_books_are_dealt_out(spark):
    """Books of a narrow table are parsed by as many tasks as an exchange has, and the id is looked for only where it is asked for."""
    for name in ("book_referees", "book_alternates", "book_id_patterns", "book_standby", "book_technicals", "gamebook_parse"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.rindex("Exchange "):]
        assert "REPARTITION_BY_NUM" in below and "FileScan" in below and "concat(" not in below
        assert ("labelled" in plan) == (name in ("book_id_patterns", "gamebook_parse"))
