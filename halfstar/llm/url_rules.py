"""URL filters: a sort-merge range join of pages with host rules, by a sorted sweep.

A host becomes a key of its labels in reverse order, each followed by a dot: ``a.example.net`` is
``net.example.a.``. The hosts below a rule's host are then an interval of keys, from ``net.`` up to, but not
including, ``net/`` (the slash follows the dot). Intervals of rules are nested or apart, so at any
key the rules that are active form a stack: it grows where an interval opens and shrinks where one closes.
Pages and these events are sorted together, and each page takes over the last stack before it. Of
the stack, longest rule first, the first whose path the page's path starts with decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import partitions

#: Verdict of pages that no rule fits.
DEFAULT_VERDICT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels in reverse order, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(rules: DataFrame) -> DataFrame:
    """Where the stack of active rules changes: ``(at, closes, stack)``, the stack longest rule first.

    A rule's ancestors are found by equality of its host's suffixes with other hosts, so the work is the number of labels in all rules.
    """
    hosts = rules.groupBy("rule_key").agg(F.collect_set(F.struct(F.length("host").alias("n"), F.length("path").alias("m"), "host", "path", "action")).alias("own"))
    labels = F.slice(F.split("rule_key", r"\."), 1, F.size(F.split("rule_key", r"\.")) - 1)
    prefix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    above = hosts.select(F.col("rule_key").alias("key"), F.explode(prefix).alias("rule_key"))
    active = above.join(hosts, "rule_key").select("key", F.explode("own").alias("rule"), (F.col("key") == F.col("rule_key")).alias("self"))
    stacks = active.groupBy("key").agg(
        F.sort_array(F.collect_set("rule"), asc=False).alias("opened"),
        F.sort_array(F.collect_set(F.when(~F.col("self"), F.col("rule"))), asc=False).alias("closed"),
    )
    end = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    events = F.array(
        F.struct(F.col("key").alias("at"), F.col("opened").alias("stack"), F.lit(1).alias("order")),
        F.struct(end.alias("at"), F.col("closed").alias("stack"), F.lit(0).alias("order")),
    )
    return stacks.select(F.inline(events))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """Verdicts for ``pages (page_id, url, ...)``: ``(page_id, host, path, rule, verdict)``, a row for each row.

    ``rules (host, path, action)``: a rule fits its host and all subdomains where the page's path starts
    with the rule's. Of several that fit, the longest host wins, then the longest path, then the last in the order of host, path and
    action. ``rule`` is host and path of the rule, NULL if none fits; the verdict is then ``default``. Rules with a NULL or empty host, or a NULL
    action, are left out; a NULL path is empty. A NULL url, or one without ``://``, has an empty host and path, which no rule
    fits. Repeated rows and NULL ids are kept; other columns are ignored. Empty tables are fine.

    Rows are dealt to salted sweeps by a hash of id and url, so a frequent host is spread. The rules' events go to every
    sweep: their number times the number of sweeps must be small against the pages.
    """
    sweeps = partitions(pages.sparkSession) * 2
    rules = rules.where("host is not null and host <> '' and action is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action"
    )
    events = _stacks(rules.distinct().withColumn("rule_key", host_key(F.col("host")))).withColumn(
        "sweep", F.explode(F.sequence(F.lit(0), F.lit(sweeps - 1)))
    )
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.pmod(F.xxhash64("page_id", "url"), F.lit(sweeps)).cast("int").alias("sweep"))
    rows = parts.withColumn("at", host_key(F.col("host"))).withColumns({"order": F.lit(2), "page": F.lit(True)})
    merged = rows.unionByName(events.withColumn("page", F.lit(False)), allowMissingColumns=True)
    sweep = Window.partitionBy("sweep").orderBy("at", "order")
    swept = merged.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))).where("page")
    fits = F.filter("stack", lambda r: F.col("path").startswith(r["path"]))
    first = F.try_element_at(fits, F.lit(1))
    return swept.select(
        "page_id",
        "host",
        "path",
        F.concat(first["host"], first["path"]).alias("rule"),
        F.coalesce(first["action"], F.lit(default)).alias("verdict"),
    )
