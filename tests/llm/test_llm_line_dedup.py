import hashlib
from collections import Counter, defaultdict

import pytest
from carrymark.llm import line_dedup
from carrymark.llm.line_dedup import LineRuns, dedup_lines, op11_line_dedup
from messy import ROWS, empty, messy
from pyspark.sql import functions as F

BLANKS = " \t\n\v\f\r"
LICENSE = "This line is in very many documents"
SCHEMA = "doc_id long, text string"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, least=3, chars=20):
    """doc_id, lines, dropped, kept text of each row, by plain loops."""
    held, last = defaultdict(set), {}
    for i, (doc, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    for k, where in held.items():
        last[k] = max((rows[i][0] for i in where if rows[i][0] is not None), default=None)
    out = Counter()
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < chars or len(held[key(x)]) < least
                or doc == last[key(x)]]
        out[doc, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect())


def many_documents():
    rows = [(i, "\n".join(filter(None, [
        f"  {LICENSE.upper() if i % 2 else LICENSE}\t", f"own line of document number {i:04d}",
        "short line" if i % 3 else None, f"shared by some documents, number {i % 7}\r",
        f"shared by some documents, number {i % 7}" if i % 5 == 0 else None,
        f"in two documents only, number {i // 2}", "  "]))) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, "\n\n"), (None, LICENSE), (63, LICENSE * 3000),
                   (64, f"é{LICENSE} "), (65, "\n".join([LICENSE] * 2000))]


def test_equals_plain_loops(spark):
    rows = many_documents()
    assert found(dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)


def test_disorder(spark):
    rows = [(r[0], r[1]) for r in ROWS] + [(9, LICENSE)] * 3 + [(None, LICENSE)] * 2
    docs = messy(spark).select("doc_id", "text", "row_", "digest", "kept").unionByName(
        spark.createDataFrame(rows[len(ROWS):], SCHEMA), allowMissingColumns=True)
    docs = docs.withColumns({c: F.lit(c) for c in ("line", "place", "docs", "last", "document",
                                                   "batch", "places", "n_lines")})
    assert found(dedup_lines(docs)) == plain(rows)
    got = op11_line_dedup(docs).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == Counter(
        {(d, n, x, hashlib.sha256(t.encode()).hexdigest()): c
         for (d, n, x, t), c in plain(rows).items()})


def test_only_documents_without_an_id(spark):
    rows = [(None, LICENSE)] * 4
    assert found(dedup_lines(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_empty_table(spark):
    assert dedup_lines(empty(spark)).count() == 0


def entries(spark, first, last):
    """Line i of 0..last-1 is in one document, i."""
    return spark.range(first, last).selectExpr(
        "unhex(md5(cast(id as string))) as line", "1L as docs", "2L as lines", "id as last")


def test_runs_are_disjoint_levelled_and_outlive_the_session(spark):
    runs = LineRuns(spark, buckets=3, fanout=2)
    for k in range(5):
        runs.add(entries(spark, 10 * k, 10 * k + 20), f"batch {k}")
    assert [len(runs.runs(level)) for level in range(3)] == [1, 0, 1]
    sizes = [runs._read(r).count() for r in runs.runs()]
    assert sorted(sizes) == [10, 50]
    later = LineRuns(spark, path=runs.path, buckets=3, fanout=2)
    later.add(entries(spark, 0, 1000), "batch 3")           # known: nothing happens
    totals = {r.last: (r.docs, r.lines) for r in later.totals().collect()}
    assert totals == {i: (2, 4) if 10 <= i < 50 else (1, 2) for i in range(60)}
    assert {r.last for r in later.totals(2).collect()} == set(range(10, 50))
    with pytest.raises(ValueError, match="3 buckets"):
        LineRuns(spark, path=runs.path, buckets=4)
    runs.close()
    later.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_documents_of_earlier_calls_count(spark):
    runs = LineRuns(spark, buckets=3)
    first, second = [(1, LICENSE), (2, LICENSE)], [(3, LICENSE), (0, f"a\n{LICENSE}")]
    got = [found(dedup_lines(spark.createDataFrame(rows, SCHEMA), batches=1, index=runs, name=n))
           for n, rows in (("one", first), ("two", second), ("two", second))]
    assert got[0] == Counter({(1, 1, 0, LICENSE): 1, (2, 1, 0, LICENSE): 1})
    assert got[1] == got[2] == Counter({(3, 1, 0, LICENSE): 1, (0, 2, 1, "a"): 1})
    runs.close()


def test_runs_are_not_shuffled(spark):
    runs = LineRuns(spark, buckets=3)
    runs.add(entries(spark, 0, 10), "a")
    runs.add(entries(spark, 5, 15), "b")
    plan = runs._met(entries(spark, 5, 15))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 2 and text.count("Exchange") == 1
    assert {r["last"]: r.known for r in plan.collect()} == dict.fromkeys(range(5, 15), True)
    runs.close()


def test_line_keys():
    assert line_dedup.line_key(" \t\v\f\rAbÄ é\u00a0 \n".encode()).decode() == "abÄ é\u00a0"
    assert [line_dedup._long(("é" * n).encode(), 20) for n in (19, 20, 100)] == [False, True, True]
