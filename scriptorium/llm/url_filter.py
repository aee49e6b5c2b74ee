"""URL filters by a sort-merge range join over reversed-host keys (native)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULE_LIMIT = 100_000


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, ASCII_UPPER, ASCII_UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """``a.b.net`` as ``net.b.a.``: a host and its subdomains are one interval."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def rule_stacks(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(key, stack)``: at each interval boundary the rules active from there on.

    One sweep over the sorted boundaries of the rule list pushes an opening
    host's rules and pops them at its end. Host intervals nest or are apart,
    so what ends is always on top. The list is a driver argument; more than
    ``RULE_LIMIT`` rules are refused.
    """
    if len(rules) > RULE_LIMIT:
        raise ValueError(f"more than {RULE_LIMIT} rules")
    hosts: dict[str, list] = {}
    for action, host, path in sorted(set(rules)):
        key = ".".join(reversed(host.lower().split("."))) + "."
        hosts.setdefault(key, []).append((host + path, path, action))
    events = [(k, 1, v) for k, v in hosts.items()]
    events += [(k[:-1] + "/", 0, []) for k in hosts]  # "/" follows "." in byte order
    events.sort(key=lambda e: (e[0].encode(), e[1]))
    stack, rows = [], []
    for key, opens, own in events:
        stack = [*stack, own] if opens else stack[:-1]
        rows.append((key, [rule for held in stack for rule in held]))
    return spark.createDataFrame(
        rows, "key string, stack array<struct<rule:string,path:string,action:string>>"
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
    buckets: int = 512,
) -> DataFrame:
    """Each row with ``host``, ``path``, ``rule`` and ``verdict`` (columns of
    those names are replaced).

    Rules are ``(action, host, path)``. Rows and boundaries are sorted by key
    and merged: a row takes the stack of the last boundary at or before it,
    then the longest stacked rule whose path its path starts with (ties: the
    longer host first, then block). Rows are dealt to buckets by a hash of the
    whole url and a random-free row digest, and every bucket holds all
    boundaries, so a hot host spreads over all of them.

    Null or odd urls have empty host and path, no rule, and the default
    verdict. Repeated rows stay repeated; an empty table gives no rows.
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    scalars = [f.name for f in pages.schema if f.dataType.typeName() in ("long", "integer", "string")]
    rows = pages.select(
        F.struct(*kept).alias("row"), host.alias("host"), path.alias("path"),
        F.pmod(F.xxhash64(*scalars), F.lit(buckets)).alias("bucket"),
    ).withColumn("key", host_key(F.col("host")))
    marks = rule_stacks(spark, rules)
    stack_type = marks.schema["stack"].dataType
    merged = rows.withColumn("kind", F.lit(1)).withColumn(
        "stack", F.lit(None).cast(stack_type)
    ).unionByName(
        marks.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
        .withColumn("kind", F.lit(0)),
        allowMissingColumns=True,
    )
    sweep = (
        Window.partitionBy("bucket").orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    fits = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(r["rule"]).alias("size"),
        (F.length(r["rule"]) - F.length(r["path"])).alias("host_size"),
        r["action"].alias("action"), r["rule"].alias("rule"),
    )))
    return (
        merged.withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
        .filter("kind = 1")
        .withColumn("best", best)
        .select(
            "row.*", "host", "path", F.col("best.rule").alias("rule"),
            F.coalesce("best.action", F.lit(default)).alias("verdict"),
        )
    )
