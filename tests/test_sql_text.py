"""the clause scanner on literal texts."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.sqltext import clause_facts

TEXTS = {
    "subquery": ("SELECT * FROM (SELECT a FROM t WHERE x=1) s JOIN (SELECT b FROM u) v ON s.a = v.b WHERE s.a > 2",
                 [("filter", "x=1"), ("join", "s.a = v.b"), ("filter", "s.a > 2")]),
    "nested case": ("SELECT CASE WHEN a=1 THEN CASE WHEN b=2 THEN 'x' END ELSE 'z' END FROM t",
                    [("case", "CASE WHEN b=2 THEN 'x' END"), ("case", "CASE WHEN a=1 THEN CASE WHEN b=2 THEN 'x' END ELSE 'z' END")]),
    "quotes": ("SELECT 'it is WHERE ' || a, \"JOIN x ON\", `CASE` FROM t WHERE a = 'b''c WHERE (' AND d = 1 ORDER BY 1",
               [("filter", "a = 'b''c WHERE (' AND d = 1")]),
    "comments": ("SELECT a -- JOIN q ON a=b\nFROM t /* WHERE c ( */ WHERE a = 1 /* z */ AND d = 1", [("filter", "a = 1  AND d = 1")]),
    "using": ("SELECT * FROM a JOIN b USING (id) LEFT OUTER JOIN c USING (x, y) WHERE a.order = 1",
              [("join", "USING (id)"), ("join", "USING (x, y)"), ("filter", "a.order = 1")]),
    "merge": ("MERGE INTO t USING (SELECT * FROM q WHERE k > 0) s ON t.id = s.id WHEN MATCHED AND s.v > 1 THEN UPDATE SET v = s.v",
              [("filter", "k > 0"), ("join", "t.id = s.id")]),
    "two joins, two ons": ("select 1 from a join b join c on b.x = c.x on a.y = b.y, d where a.z", [("join", "b.x = c.x"), ("join", "a.y = b.y"), ("filter", "a.z")]),
    "exists": ("SELECT 1 FROM a WHERE EXISTS (SELECT 1 FROM e WHERE e.k = a.k) GROUP BY 1",
               [("filter", "e.k = a.k"), ("filter", "EXISTS (SELECT 1 FROM e WHERE e.k = a.k)")]),
    "filter of an aggregate": ("SELECT count(*) FILTER (WHERE z > 0) OVER (PARTITION BY a ORDER BY b) FROM t", [("filter", "z > 0")]),
    "on without join": ("GRANT SELECT ON t TO r; CREATE INDEX i ON t (a); INSERT INTO x SELECT * FROM y ON CONFLICT (id) DO NOTHING", []),
    "delete using": ("delete from t using u where t.a=u.a;", [("filter", "t.a=u.a")]),
    "case in a condition": ("SELECT 1 FROM a INNER JOIN b ON CASE WHEN a.x = 1 THEN b.y ELSE b.z END = a.k NATURAL JOIN c CROSS JOIN d WHERE r",
                            [("case", "CASE WHEN a.x = 1 THEN b.y ELSE b.z END"), ("join", "CASE WHEN a.x = 1 THEN b.y ELSE b.z END = a.k"), ("filter", "r")]),
    "block": ("BEGIN UPDATE t SET a = CASE b WHEN 1 THEN 2 END WHERE c = LEFT(d, 1); DELETE FROM u WHERE v; END;",
              [("case", "CASE b WHEN 1 THEN 2 END"), ("filter", "c = LEFT(d, 1)"), ("filter", "v")]),
    "union": ("SELECT a FROM t WHERE a = 1 UNION ALL SELECT b FROM u WHERE b = 2 LIMIT 3", [("filter", "a = 1"), ("filter", "b = 2")]),
    "open end": ("SELECT a FROM t WHERE a IN (SELECT b FROM u WHERE c = 'open", [("filter", "a IN (SELECT b FROM u WHERE c = 'open"), ("filter", "c = 'open")]),
    "unbalanced": (") SELECT END a) FROM t WHERE b = 1) ; SELECT CASE x FROM u WHERE y; SELECT 1 FROM v WHERE w", [("filter", "b = 1)"), ("filter", "w")]),
    "dollar quoted": ("CREATE PROCEDURE p() AS $$ SELECT 1 FROM t WHERE x $$", []),
    "nothing": ("SELECT 1", []), "empty": ("", []), "blank": (" \n", []),
}


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in TEXTS.items()] + [("null", None)], "k string, t string")
    return {r["k"]: r["f"] for r in df.select("k", clause_facts(F.col("t")).alias("f")).collect()}


@pytest.mark.parametrize("name", TEXTS)
def test_facts(found, name):
    assert [tuple(x) for x in found[name]] == TEXTS[name][1]


def test_null_text_has_no_facts(found):
    assert found["null"] is None


def test_long_text(spark):
    n = 300
    items = ", ".join(f"CASE WHEN a{i} = '{i}' THEN (SELECT max(x) FROM t{i} WHERE y = {i}) END" for i in range(n))
    got = spark.createDataFrame([(f"SELECT {items} FROM a JOIN b ON a.i = b.i",)], "t string").select(F.inline(clause_facts(F.col("t")))).collect()
    kinds = [r["kind"] for r in got]
    assert (kinds.count("case"), kinds.count("filter"), kinds.count("join")) == (n, n, 1)
