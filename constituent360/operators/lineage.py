"""Table lineage from module text and dependency metadata, as joins and aggregations."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions.numbers import count_if
from constituent360.session import cut_lineage

# How a module names a table, and how it runs text as SQL.
TABLE_PATTERN = r"(?i)(?:from|join|into|update)\s+([\w.\[\]]+)"
DYNAMIC_PATTERN = r"(?i)EXEC\(|sp_executesql"
WRITER_PATTERN = r"(?is)INSERT|MERGE|SELECT.*INTO"
ROUNDS_PER_TABLE = 16


def clean_name(c: Column) -> Column:
    """Lower-case name without brackets and schema."""
    return F.lower(F.substring_index(F.regexp_replace(c, r"[\[\]]", ""), ".", -1))


def extract_refs(modules: DataFrame, assets: DataFrame) -> DataFrame:
    """(object, referenced, confidence): names found in module text that are known assets."""
    found = modules.select(
        "object_name", F.explode(F.regexp_extract_all("definition", F.lit(TABLE_PATTERN), 1)).alias("raw")
    ).select("object_name", clean_name(F.col("raw")).alias("referenced")).distinct()
    known = assets.select(clean_name(F.col("name")).alias("referenced")).distinct()
    return found.join(known, "referenced", "left_semi").select(
        "object_name", "referenced", F.lit("Medium").alias("confidence")
    )


def lineage_edges(dependencies: DataFrame, objects: DataFrame, modules: DataFrame) -> DataFrame:
    """Direction and confidence per dependency: written when updated, otherwise read; high for views and
    static code, medium where the module runs dynamic SQL."""
    dynamic = modules.select("object_name", F.col("definition").rlike(DYNAMIC_PATTERN).alias("dynamic"))
    kinds = objects.select(F.col("name").alias("object_name"), "type")
    joined = dependencies.join(kinds, "object_name", "left").join(dynamic, "object_name", "left")
    return joined.select(
        "object_name", "referenced",
        F.when(F.col("is_updated") == 1, "WRITE").otherwise("READ").alias("lineage_type"),
        F.when(F.col("type") == "VIEW", "High").when(F.coalesce("dynamic", F.lit(False)), "Medium").otherwise("High").alias("confidence"),
    )


def source_tables(objects: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """Tables that no foreign key refers to."""
    return objects.where(F.col("type") == "TABLE").select("name").join(
        foreign_keys.select(F.col("referenced").alias("name")), "name", "left_anti"
    )


def object_inventory(objects: DataFrame) -> DataFrame:
    return objects.groupBy("type").agg(F.count("*").alias("objects")).orderBy(F.col("objects").desc(), "type")


def writer_modules(modules: DataFrame) -> DataFrame:
    return modules.where(F.col("definition").rlike(WRITER_PATTERN)).select("object_name")


def dynamic_modules(modules: DataFrame) -> DataFrame:
    return modules.where(F.col("definition").rlike(DYNAMIC_PATTERN)).select("object_name")


def view_columns(views: DataFrame, columns: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Columns of a view and of the tables it reads that carry the same name."""
    mine = views.select(F.col("name").alias("view_name")).join(
        columns.select(F.col("object_name").alias("view_name"), F.col("column_name").alias("view_column")), "view_name"
    )
    reads = dependencies.select(F.col("object_name").alias("view_name"), F.col("referenced").alias("source_table")).distinct()
    theirs = columns.select(F.col("object_name").alias("source_table"), F.col("column_name").alias("source_column"))
    # the view's own column is part of the key, so a wide view does not meet every source column
    candidates = reads.join(theirs, "source_table").withColumn("view_column", F.col("source_column"))
    return mine.join(candidates, ["view_name", "view_column"]).select("view_name", "view_column", "source_table", "source_column")


def downstream(edges: DataFrame, roots: DataFrame, source: str = "referenced", target: str = "object_name") -> DataFrame:
    """(node, distance) of everything reachable from the roots. Each round follows the newly reached
    nodes only and writes them; the written rounds together are what has been seen."""
    e = edges.select(F.col(source).alias("s"), F.col(target).alias("t")).distinct()
    frontier = cut_lineage(roots.select(F.col(roots.columns[0]).alias("node")).distinct())
    seen = frontier.withColumn("distance", F.lit(0))
    for step in count(1):  # to the fix-point: every round reaches a new node or ends
        reached = frontier.join(e, F.col("node") == F.col("s")).select(F.col("t").alias("node")).distinct()
        frontier = cut_lineage(reached.join(seen.select("node"), "node", "left_anti"))
        if frontier.isEmpty():
            return seen.where("distance > 0")
        seen = seen.unionByName(frontier.withColumn("distance", F.lit(step)))
        if step % ROUNDS_PER_TABLE == 0:
            seen = cut_lineage(seen)


def upstream(edges: DataFrame, roots: DataFrame, source: str = "referenced", target: str = "object_name") -> DataFrame:
    return downstream(edges, roots, target, source)


def _trim(edges: DataFrame) -> DataFrame:
    """Drop edges at nodes without a way in or out until none is left to drop."""
    size = edges.count()
    while size:
        both = edges.select(F.col("s").alias("n")).distinct().join(edges.select(F.col("t").alias("n")).distinct(), "n", "left_semi")
        edges = cut_lineage(
            edges.join(both.withColumnRenamed("n", "s"), "s", "left_semi").join(both.withColumnRenamed("n", "t"), "t", "left_semi").select("s", "t")
        )
        now = edges.count()
        if now == size:
            break
        size = now
    return edges


def cycles(edges: DataFrame, source: str = "referenced", target: str = "object_name") -> DataFrame:
    """(node, cycle): nodes on a circular dependency, with the least node of their strongly connected
    group. Colours flow forward (least reaching node wins) to a fixpoint; a group is what its colour's
    own node is reachable from within the colour; found groups are removed and the rest is repeated."""
    e = edges.select(F.col(source).alias("s"), F.col(target).alias("t")).distinct()
    loops = e.where("s = t").select(F.col("s").alias("node"), F.col("s").alias("cycle"))
    rest = _trim(cut_lineage(e.where("s <> t")))
    found = None
    while not rest.isEmpty():  # every round settles the least node that is left
        nodes = rest.select(F.explode(F.array("s", "t")).alias("node")).distinct()
        colour = cut_lineage(nodes.withColumn("c", F.col("node")))
        while True:
            offered = rest.join(colour.withColumnRenamed("node", "s"), "s").groupBy(F.col("t").alias("node")).agg(F.min("c").alias("o"))
            after = cut_lineage(
                colour.join(offered, "node", "left").select("node", F.least("c", F.coalesce("o", "c")).alias("c"), (F.coalesce("o", "c") < F.col("c")).alias("moved"))
            )
            colour = after.drop("moved")
            if after.where("moved").isEmpty():
                break
        inside = rest.join(colour.select(F.col("node").alias("s"), F.col("c").alias("cs")), "s").join(
            colour.select(F.col("node").alias("t"), F.col("c").alias("ct")), "t"
        ).where("cs = ct")
        back = inside.select(F.col("t").alias("s"), F.col("s").alias("t"))
        roots = colour.where("node = c").select("node")
        reached = downstream(back, roots, "s", "t").select("node").unionByName(roots).distinct()
        group = colour.join(reached, "node", "left_semi")
        sizes = group.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c")
        part = group.join(sizes, "c", "left_semi").select("node", F.col("c").alias("cycle"))
        found = part if found is None else found.unionByName(part)
        done = group.select("node")
        rest = _trim(cut_lineage(
            rest.join(done.withColumnRenamed("node", "s"), "s", "left_anti").join(done.withColumnRenamed("node", "t"), "t", "left_anti").select("s", "t")
        ))
    out = loops if found is None else found.unionByName(loops)
    return out.groupBy("node").agg(F.min("cycle").alias("cycle"))


def changed_objects(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Modules whose definition hash is new, changed or gone."""
    hashed = lambda df, name: df.select("object_name", F.sha2("definition", 256).alias(name))
    both = hashed(previous, "old_hash").join(hashed(current, "new_hash"), "object_name", "full")
    kind = F.when(F.col("old_hash").isNull(), "added").when(F.col("new_hash").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("old_hash").eqNullSafe(F.col("new_hash"))).select("object_name", kind.alias("change"))


def lineage_coverage(objects: DataFrame, edges: DataFrame) -> DataFrame:
    """Share of objects with lineage, and with high-confidence lineage, in percent."""
    ends = edges.select(F.explode(F.array("object_name", "referenced")).alias("name"), (F.col("confidence") == "High").alias("high"))
    per = ends.groupBy("name").agg(F.bool_or("high").alias("high"))
    joined = objects.select("name").distinct().join(per, "name", "left")
    return joined.agg(
        F.count("*").alias("objects"),
        (count_if(F.col("high").isNotNull()) * 100.0 / F.count("*")).cast("double").alias("with_lineage_pct"),
        (count_if(F.col("high")) * 100.0 / F.count("*")).cast("double").alias("high_confidence_pct"),
    )


def freshness_gap(source: DataFrame, target: DataFrame, date: str) -> DataFrame:
    """Row counts and latest load dates of both sides, and how many days the target is behind."""
    side = lambda df, n: df.agg(F.max(date).cast("date").alias("latest"), F.count("*").alias("rows")).select(F.lit(n).alias("side"), "latest", "rows")
    pick = lambda n, c: F.max(F.when(F.col("side") == n, F.col(c)))
    return side(source, "source").unionByName(side(target, "target")).agg(
        pick("source", "latest").alias("source_latest"), pick("target", "latest").alias("target_latest"),
        pick("source", "rows").alias("source_rows"), pick("target", "rows").alias("target_rows"),
    ).withColumn("days_behind", F.datediff("source_latest", "target_latest"))


def job_lineage(steps: DataFrame, assets: DataFrame) -> DataFrame:
    """(job, step, table): the known tables each job step names, in execution order."""
    modules = steps.select(F.concat_ws("|", "job", F.col("step_id").cast("string")).alias("object_name"), F.col("command").alias("definition"))
    refs = extract_refs(modules, assets)
    parts = F.split("object_name", r"\|")
    return refs.select(parts[0].alias("job"), parts[1].cast("int").alias("step_id"), "referenced").orderBy("job", "step_id", "referenced")
