"""URL rules by a sort-merge range join over reversed-host keys (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from yieldlens.llm.common import partitions, spread

#: Ends each label of a key. Labels that hold it have it written with ESCAPE, so a key is a prefix of its subdomains' keys only.
END, ESCAPE = "\x01", "\x02"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = T.StructType(
    [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("verdict", T.StringType())]
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/ ? #`` (A-Z lower-cased) and the path up to ``? #``.

    Both are empty for a null url and for one without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    shape = "^([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(rest, shape, 1), UPPER, LOWER), F.regexp_extract(rest, shape, 2)


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed by END: a host and its subdomains are one interval of keys."""
    plain = F.replace(F.replace(host, F.lit(ESCAPE), F.lit(ESCAPE + "\x03")), F.lit(END), F.lit(ESCAPE + ESCAPE))
    return F.concat(F.array_join(F.reverse(F.split(plain, r"\.")), END), F.lit(END))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)


def _stacks(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key and the rules of that host and of the hosts around it, longest first.

    A host is nested in the hosts that are its endings, so those are found by an equi-join
    on the endings, not by comparing rules.
    """
    clean = (
        rules.where(F.col("host").isNotNull() & (F.col("host") != "") & F.col("verdict").isNotNull())
        .select(
            F.translate("host", UPPER, LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            F.col("verdict").cast("string").alias("verdict"),
        )
        # of equal rules with different verdicts, block wins
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    )
    own = clean.groupBy("host").agg(
        F.collect_list(
            F.struct(
                (-F.length(F.concat("host", "path"))).alias("order"),
                (-F.length("host")).alias("order_host"),
                F.concat("host", "path").alias("rule"),
                "path",
                "verdict",
                host_key(F.col("host")).alias("prefix"),
            )
        ).alias("rules")
    )
    labels = F.split("host", r"\.")
    endings = own.select(
        "host",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels)),
                lambda i: F.array_join(F.slice(F.split("host", r"\."), i, F.size(F.split("host", r"\."))), "."),
            )
        ).alias("around"),
    )
    return (
        endings.join(own.select(F.col("host").alias("around"), "rules"), "around")
        .groupBy("host")
        .agg(F.sort_array(F.flatten(F.collect_list("rules"))).alias("stack"))
        .select(host_key(F.col("host")).alias("key"), "stack")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """``id, host, path, rule, verdict`` for each row of ``pages``.

    A rule (host, path, verdict) fits its host and all subdomains when the url's path
    starts with the rule's path. The longest rule wins (host and path together; then the
    longer host). Without a rule ``rule`` is null and the verdict ``default``.

    Rules become intervals of reversed-host keys. Rules and urls are sorted together by
    key; the last rule host at or before a url carries the stack of nested hosts open
    there, and the url takes the first of the stack whose prefix and path fit. The sweep
    runs in as many even shares of the urls as there are shuffle partitions, whatever
    their hosts, and each share sees all rule hosts: a hot host is spread out.

    Rules with a null or empty host or a null verdict are ignored, a null path is empty, and
    of two equal rules the alphabetically last verdict (``block``) holds. Null urls and urls without
    ``://`` have an empty host and path and fit no rule. Repeated rows each get a row; other
    columns, whatever their names, are not read; an empty table gives no rows and an empty rule table
    gives each url the default.
    """
    shares = partitions(pages.sparkSession)
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    sought = pages.select(F.col(f"`{id_column}`").alias("id"), host.alias("host"), path.alias("path")).select(
        spread(shares).alias("share"), F.lit(1).alias("kind"), host_key(F.col("host")).alias("key"), "id", "host", "path"
    )
    opened = _stacks(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("kind"), "key", "stack"
    )
    both = sought.unionByName(opened, allowMissingColumns=True)
    sweep = Window.partitionBy("share").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = both.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fitting = F.get(
        F.filter("open", lambda r: F.col("key").startswith(r["prefix"]) & F.col("path").startswith(r["path"])), F.lit(0)
    )
    return last.withColumn("found", fitting).select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"),
    )
