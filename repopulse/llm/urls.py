"""URL rules by a sorted sweep.

A rule has a host and a path. In the order of reversed host, then path, the URLs
that it fits on one host name form an interval, and such intervals are nested or
apart. So in a sweep over rules and URLs in that order, the rule met last and those
around it are the only ones that can fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.expressions import LOWER, UPPER
from repopulse.llm.sweep import in_order
from repopulse.session import staged

STACK = "array<struct<path:string,verdict:string>>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://`, A-Z lower-cased, and path; both empty without one."""
    mark = F.instr(url, "://")
    rest = F.coalesce(F.when(mark > 0, F.substring(url, mark + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule with all rules of its host whose path starts its own, the shortest first.

    Only path lengths that some rule has are looked up, so a rule takes part in no
    more rows than there are such lengths.
    """
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    cuts = rules.select(
        "key",
        "path",
        F.explode(F.array(*map(F.lit, sorted(lengths)))).alias("n"),
    ).where("n <= length(path)")
    around = cuts.select("key", "path", F.expr("left(path, n)").alias("outer_path"))
    outer = rules.select(
        F.col("key").alias("outer_key"), F.col("path").alias("its_path"), "verdict"
    )
    found = around.join(
        outer, (F.col("key") == F.col("outer_key")) & (F.col("outer_path") == F.col("its_path"))
    )
    stack = F.sort_array(
        F.collect_list(F.struct(F.col("outer_path").alias("path"), "verdict"))
    )
    return found.groupBy("key", "path").agg(stack.alias("stack"))


def judge(
    spark: SparkSession, pages: DataFrame, rules: DataFrame, default: str = "allow"
) -> DataFrame:
    """All columns of `pages` in the struct `row`, with host, path, rule and verdict.

    `rules` has host, path and verdict (allow or block). A rule fits its host and
    all subdomains if the URL's path starts with the rule's; the longest rule
    (host and path together, then host) wins, and of equal rules that blocks. The
    rule is given as host and path in one string, or null, with the verdict
    `default`, if none fits. A null URL or one without `://` has an empty host and
    path, which fit no rule with a host. Null rule fields count as empty; repeated
    pages are judged alike; empty tables are fine.

    Equal URLs are swept once, and only for the names above their host that have a
    rule. The rules' lengths and the greatest depth of a host reach the driver.
    """
    host, path = host_and_path(F.col("url"))
    row = F.struct(*(pages[f"`{c}`"] for c in pages.columns)).alias("row")
    parsed = pages.select(row, host.alias("host"), path.alias("path"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    known = (
        rules.select(_reversed(text("host")).alias("key"), text("path").alias("path"), "verdict")
        .groupBy("key", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    deepest = known.select(F.max(F.size(F.split("key", r"\.")))).first()[0] or 0
    stacks = _stacks(known)
    labels = F.reverse(F.split("host", r"\."))
    names = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
        lambda i: F.array_join(F.slice(labels, F.lit(1), i), "."),
    )
    urls = parsed.select("host", "path").distinct()
    probes = urls.select(F.explode(names).alias("key"), "path", "host").join(
        stacks.select("key").distinct(), "key", "left_semi"
    )
    events = stacks.select("key", "path", F.lit(None).cast("string").alias("host"), "stack").unionByName(
        probes.select("key", "path", "host", F.lit(None).cast(STACK).alias("stack"))
    )
    order = [F.col("key"), F.col("path"), F.col("host").asc_nulls_first()]
    ordered = in_order(spark, events, *order)
    met = F.when(F.col("stack").isNotNull(), F.struct("key", "stack"))
    last_met = F.last(met, ignorenulls=True)
    # The rule that each partition ends with: one row per partition.
    ends = ordered.groupBy("part").agg(F.max(F.when(F.col("stack").isNotNull(), F.struct("key", "path", "stack"))).alias("end"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", F.last("end", ignorenulls=True).over(before).alias("carried"))
    own = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        ordered.withColumn("met", last_met.over(own))
        .where("host is not null")
        .join(carried, "part")
        .withColumn(
            "met", F.coalesce("met", F.struct(F.col("carried.key"), F.col("carried.stack")))
        )
    )
    inside = F.filter("met.stack", lambda r: F.startswith(F.col("path"), r["path"]))
    fitting = swept.where(F.col("met.key") == F.col("key")).select(
        "host", "path", "key", F.get(inside, F.size(inside) - 1).alias("rule")
    )
    fitting = fitting.where("rule is not null")
    length = F.length("key") + F.length("rule.path")
    best = fitting.groupBy("host", "path").agg(
        F.max(
            F.struct(
                length.alias("length"),
                F.length("key").alias("host_length"),
                F.concat(_reversed(F.col("key")), "rule.path").alias("rule"),
                F.col("rule.verdict").alias("verdict"),
            )
        ).alias("best")
    )
    # Staged, so that the join can split the rows of a frequent URL.
    best = staged(spark, best, "verdicts")
    return parsed.join(best, ["host", "path"], "left").select(
        "row",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def allowed(spark: SparkSession, pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The pages that the rules let through, with their columns."""
    return judge(spark, pages, rules).where("verdict = 'allow'").select("row.*")
