"""Lineage queries over modules whose text is derived from the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from constituent360.operators import lineage as N
from constituent360.plans.registry import query
from constituent360.sources import tpch

_NAME = lambda k: F.concat(F.lit("obj_"), k.cast("string"))


def modules(spark, sf_dir):
    """One module per document: it reads the object with half its number, some write another, some run
    dynamic SQL, some read a child of theirs (a cycle); the document's whole text follows as comment."""
    d = tpch.table(spark, sf_dir, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    sql = F.concat(
        F.when(i % 5 == 0, F.concat(F.lit("INSERT INTO [dbo].["), _NAME(i + 1), F.lit("] "))).otherwise(""),
        F.lit("SELECT * FROM [dbo].["), _NAME(F.floor(i / 2)), F.lit("] "),
        F.when(i % 100 == 7, F.concat(F.lit("Join dbo."), _NAME(i * 2 + 1), F.lit(" "))).otherwise(""),
        F.when(i % 9 == 0, "EXEC('x') ").otherwise(""), F.lit("-- "), F.col("text"),
    )
    return d.select(_NAME(i).alias("object_name"), i, sql.alias("definition"))


MODULES = """modules AS (SELECT 'obj_' || doc_id AS object_name, doc_id, CASE WHEN doc_id % 5 = 0 THEN 'INSERT INTO [dbo].[obj_' || (doc_id + 1) || '] ' ELSE '' END
  || 'SELECT * FROM [dbo].[obj_' || (doc_id // 2) || '] ' || CASE WHEN doc_id % 100 = 7 THEN 'Join dbo.obj_' || (doc_id * 2 + 1) || ' ' ELSE '' END
  || CASE WHEN doc_id % 9 = 0 THEN 'EXEC(''x'') ' ELSE '' END || '-- ' || text AS definition FROM documents),
refs AS (SELECT DISTINCT object_name, lower(string_split(replace(replace(r, '[', ''), ']', ''), '.')[-1]) AS referenced
  FROM (SELECT object_name, unnest(regexp_extract_all(definition, '(?i)(?:from|join|into|update)\\s+([\\w.\\[\\]]+)', 1)) AS r FROM modules)),
known AS (SELECT * FROM refs WHERE referenced IN (SELECT 'obj_' || doc_id FROM documents)),
reads AS (SELECT 'obj_' || doc_id AS object_name, 'obj_' || (doc_id // 2) AS referenced, 0 AS is_updated FROM documents WHERE doc_id > 0
  UNION ALL SELECT 'obj_' || doc_id, 'obj_' || (doc_id * 2 + 1), 0 FROM documents WHERE doc_id % 100 = 7 AND doc_id * 2 + 1 <= (SELECT max(doc_id) FROM documents)
  UNION ALL SELECT 'obj_' || doc_id, 'obj_' || (doc_id + 1), 1 FROM documents WHERE doc_id % 5 = 0),
objects AS (SELECT 'obj_' || doc_id AS name, CASE doc_id % 3 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' ELSE 'PROCEDURE' END AS type FROM documents)"""


def objects(spark, sf_dir):
    i = F.col("doc_id")
    kind = F.when(i % 3 == 0, "TABLE").when(i % 3 == 1, "VIEW").otherwise("PROCEDURE")
    return tpch.table(spark, sf_dir, "documents").select(_NAME(i).alias("name"), kind.alias("type"))


def dependencies(spark, sf_dir):
    d = tpch.table(spark, sf_dir, "documents").select("doc_id")
    i = F.col("doc_id")
    edge = lambda df, to, w: df.select(_NAME(i).alias("object_name"), _NAME(to).alias("referenced"), F.lit(w).alias("is_updated"), to.alias("_to"))
    extra = edge(d.where(i % 100 == 7), i * 2 + 1, 0).join(d.select(i.alias("_to")), "_to", "left_semi")
    return edge(d.where(i > 0), F.floor(i / 2), 0).unionByName(extra).unionByName(edge(d.where(i % 5 == 0), i + 1, 1)).drop("_to")


def read_edges(spark, sf_dir):
    return dependencies(spark, sf_dir).where("is_updated = 0")


@query("lineage_references", f"WITH {MODULES} SELECT object_name, referenced, 'Medium' AS confidence FROM known")
def _(spark, sf_dir):
    return N.extract_refs(modules(spark, sf_dir), objects(spark, sf_dir))


EDGES = f"""{MODULES}, edges AS (SELECT r.object_name, r.referenced, CASE WHEN is_updated = 1 THEN 'WRITE' ELSE 'READ' END AS lineage_type,
  CASE WHEN o.type = 'VIEW' THEN 'High' WHEN regexp_matches(definition, '(?i)EXEC\\(|sp_executesql') THEN 'Medium' ELSE 'High' END AS confidence
  FROM reads r LEFT JOIN objects o ON o.name = r.object_name LEFT JOIN modules m ON m.object_name = r.object_name)"""


def edges(spark, sf_dir):
    return N.lineage_edges(dependencies(spark, sf_dir), objects(spark, sf_dir), modules(spark, sf_dir))


@query("lineage_edges", f"WITH {EDGES} SELECT * FROM edges")
def _(spark, sf_dir):
    return edges(spark, sf_dir)


@query("lineage_coverage", f"""WITH {EDGES}, e AS (SELECT object_name AS name, confidence FROM edges UNION ALL SELECT referenced, confidence FROM edges), p AS (SELECT name, bool_or(confidence = 'High') AS high FROM e GROUP BY 1)
SELECT count(*) AS objects, count(high) * 100.0 / count(*) AS with_lineage_pct, count(*) FILTER (high) * 100.0 / count(*) AS high_confidence_pct FROM objects LEFT JOIN p USING (name)""")
def _(spark, sf_dir):
    return N.lineage_coverage(objects(spark, sf_dir), edges(spark, sf_dir))


@query("lineage_source_tables", f"WITH {MODULES} SELECT name FROM objects WHERE type = 'TABLE' AND name NOT IN (SELECT referenced FROM reads WHERE is_updated = 0)")
def _(spark, sf_dir):
    return N.source_tables(objects(spark, sf_dir), read_edges(spark, sf_dir))


@query("lineage_inventory", f"WITH {MODULES} SELECT type, count(*) AS objects FROM objects GROUP BY 1")
def _(spark, sf_dir):
    return N.object_inventory(objects(spark, sf_dir))


@query("lineage_writers", f"WITH {MODULES} SELECT object_name FROM modules WHERE regexp_matches(definition, '(?is)INSERT|MERGE|SELECT.*INTO')")
def _(spark, sf_dir):
    return N.writer_modules(modules(spark, sf_dir))


@query("lineage_dynamic", f"WITH {MODULES} SELECT object_name FROM modules WHERE regexp_matches(definition, '(?i)EXEC\\(|sp_executesql')")
def _(spark, sf_dir):
    return N.dynamic_modules(modules(spark, sf_dir))


COLUMNS = "columns AS (SELECT 'obj_' || doc_id AS object_name, lang AS column_name FROM documents UNION ALL SELECT 'obj_' || doc_id, source FROM documents)"


@query("lineage_view_columns", f"""WITH {MODULES}, {COLUMNS} SELECT v.name AS view_name, a.column_name AS view_column, r.referenced AS source_table, b.column_name AS source_column
FROM (SELECT name FROM objects WHERE type = 'VIEW') v JOIN columns a ON a.object_name = v.name JOIN (SELECT DISTINCT object_name, referenced FROM reads) r ON r.object_name = v.name
JOIN columns b ON b.object_name = r.referenced AND b.column_name = a.column_name""")
def _(spark, sf_dir):
    d = tpch.table(spark, sf_dir, "documents")
    columns = d.select(_NAME(F.col("doc_id")).alias("object_name"), F.explode(F.array("lang", "source")).alias("column_name"))
    views = objects(spark, sf_dir).where("type = 'VIEW'")
    return N.view_columns(views, columns, dependencies(spark, sf_dir))


REACH = f"""reach(root, node) AS (SELECT object_name, referenced FROM reads WHERE is_updated = 0 UNION SELECT r.root, e.referenced FROM reach r JOIN (SELECT * FROM reads WHERE is_updated = 0) e ON r.node = e.object_name)"""


@query("lineage_downstream", f"""WITH RECURSIVE {MODULES}, d(node, distance) AS (SELECT 'obj_3', 0 UNION SELECT e.object_name, d.distance + 1 FROM d JOIN reads e ON e.referenced = d.node AND is_updated = 0 WHERE distance < 30)
SELECT node, min(distance) AS distance FROM d GROUP BY 1 HAVING min(distance) > 0""")
def _(spark, sf_dir):
    roots = objects(spark, sf_dir).where("name = 'obj_3'").select("name")
    return N.downstream(read_edges(spark, sf_dir), roots)


@query("lineage_cycles", f"""WITH RECURSIVE {MODULES}, {REACH}, c AS (SELECT root FROM reach WHERE root = node)
SELECT c.root AS node, least(c.root, min(a.node)) AS cycle FROM c JOIN reach a ON a.root = c.root JOIN reach b ON b.root = a.node AND b.node = c.root GROUP BY 1, c.root""")
def _(spark, sf_dir):
    return N.cycles(read_edges(spark, sf_dir))


@query("lineage_changed_objects", f"""WITH {MODULES}, cur AS (SELECT object_name, CASE WHEN doc_id % 10 = 3 THEN definition || ' changed' ELSE definition END AS definition FROM modules WHERE doc_id % 11 <> 0),
prev AS (SELECT object_name, definition FROM modules WHERE doc_id % 13 <> 0)
SELECT coalesce(prev.object_name, cur.object_name) AS object_name, CASE WHEN prev.object_name IS NULL THEN 'added' WHEN cur.object_name IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM prev FULL JOIN cur ON prev.object_name = cur.object_name WHERE prev.definition IS DISTINCT FROM cur.definition""")
def _(spark, sf_dir):
    m = modules(spark, sf_dir)
    i = F.col("doc_id")
    current = m.where(i % 11 != 0).withColumn("definition", F.when(i % 10 == 3, F.concat("definition", F.lit(" changed"))).otherwise(F.col("definition")))
    return N.changed_objects(m.where(i % 13 != 0), current)


@query("lineage_freshness", """SELECT s.d AS source_latest, t.d AS target_latest, s.n AS source_rows, t.n AS target_rows, datediff('day', t.d, s.d) AS days_behind
FROM (SELECT max(CAST(l_shipdate AS DATE)) AS d, count(*) AS n FROM lineitem) s, (SELECT max(CAST(o_orderdate AS DATE)) AS d, count(*) AS n FROM orders) t""")
def _(spark, sf_dir):
    date = lambda name, c: tpch.table(spark, sf_dir, name).select(F.col(c).alias("loaded"))
    return N.freshness_gap(date("lineitem", "l_shipdate"), date("orders", "o_orderdate"), "loaded")


@query("lineage_jobs", f"""WITH {MODULES} SELECT 'job_' || (doc_id % 40) AS job, doc_id AS step_id, referenced FROM modules JOIN known USING (object_name)""")
def _(spark, sf_dir):
    steps = modules(spark, sf_dir).select(
        F.concat(F.lit("job_"), (F.col("doc_id") % 40).cast("string")).alias("job"), F.col("doc_id").alias("step_id"), F.col("definition").alias("command"),
    )
    return N.job_lineage(steps, objects(spark, sf_dir))
