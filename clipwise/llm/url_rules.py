"""URL filters: fixed host rules, then association rules mined by FP-growth; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, table

#: Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a url; all empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    none = url.isNull()
    return tuple(F.when(none, "").otherwise(x) for x in (host, path, query))  # type: ignore[return-value]


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest (host, path) rule that fits, as struct(n, rule, verdict), or null."""
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits))


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """Sorted distinct tokens: host labels with their place from the right, path parts, query keys.

    Runs of digits count as one token ``#``, so that page numbers don't make every url unique.
    """
    labels = F.reverse(F.filter(F.split(host, r"\."), lambda x: x != ""))
    hosts = F.transform(labels, lambda x, i: F.concat(F.lit("h"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), x))
    steps = F.filter(F.split(F.regexp_replace(ascii_lower(path), "[0-9]+", "#"), "/"), lambda x: x != "")
    keys = F.filter(F.split(F.regexp_replace(ascii_lower(query), "=[^&]*", ""), "&"), lambda x: x != "")
    paths = F.transform(steps, lambda x: F.concat(F.lit("p:"), x))
    return F.array_sort(F.array_distinct(F.concat(hosts, paths, F.transform(keys, lambda x: F.concat(F.lit("q:"), x)))))


def classes_of(labelled: DataFrame, min_rows: int) -> DataFrame:
    """token, class, freq: tokens of ``min_rows`` labelled rows, those that stand in the same rows under one class.

    FP-growth would list every subset of such tokens with the same support and confidence, 2**k itemsets for k tokens; as
    one item they give one. A url has a class if it has any of its tokens, which is what the single-token rules among
    those subsets say, so no rule is lost. Row sets are compared by their size and two 64-bit sums of row hashes.
    """
    row = F.xxhash64("page_id", "tokens")
    each = labelled.select(row.alias("h"), F.explode("tokens").alias("token"))
    told = each.groupBy("token").agg(F.count("*").alias("freq"), F.bit_xor("h").alias("x"), F.sum(F.shiftrightunsigned("h", 24)).alias("s"))
    told = told.where(F.col("freq") >= min_rows)
    first = told.groupBy("freq", "x", "s").agg(F.min("token").alias("class"))
    return told.join(first, ["freq", "x", "s"]).select("token", "class", "freq")


def mine(labelled: DataFrame, classes: DataFrame, min_rows: float, min_confidence: float = 0.0, alpha: float = 0.05) -> DataFrame:
    """Rules from sets of token classes to ``label``, mined by FP-growth over all labelled rows.

    ``labelled`` has page_id, tokens and label. Returns antecedent, verdict, confidence, lift, rows (that the antecedent and
    the verdict share), z and ``class``, the rule's rarest one, by which it is indexed. A rule must hold in ``min_rows`` rows,
    and its confidence must lie above its label's share of all rows by more than chance: z, by how many standard
    deviations it does, must pass the normal quantile of ``alpha`` over the number of candidate rules (Bonferroni).
    So a rare label gets rules as soon as its rate rises, and labels that have nothing to do with urls get none.
    """
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    each = labelled.select("page_id", "tokens", "label", F.explode("tokens").alias("token")).join(classes.select("token", "class"), "token")
    items = each.groupBy("page_id", "tokens", "label").agg(F.collect_set("class").alias("items"))
    items = items.select(F.concat("items", F.array(F.concat(F.lit("y:"), "label"))).alias("items"))
    items = materialize(items, "url-items")
    model = FPGrowth(itemsCol="items", minSupport=min((min_rows - 0.5) / n, 1.0), minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("y:") & ~F.exists("antecedent", lambda x: x.startswith("y:")))
    base = F.element_at(F.create_map(*[F.lit(x) for y, k in counts.items() for x in (y, k / n)]), F.col("verdict"))
    shown = F.round(F.col("support") * n).cast("long")
    rules = rules.select(
        F.array_sort("antecedent").alias("antecedent"),
        F.expr("substring(consequent[0], 3)").alias("verdict"),
        "confidence",
        "lift",
        shown.alias("rows"),
    ).withColumn("z", F.try_divide(F.col("confidence") - base, F.sqrt(base * (1 - base) / (F.col("rows") / F.col("confidence")))))
    rules = materialize(rules, "url-rules")
    least = NormalDist().inv_cdf(1 - alpha / max(1, rules.count()))
    single = classes.groupBy("class").agg(F.first("freq").alias("freq"))
    each = rules.where(F.col("z") >= least).withColumn("class", F.explode("antecedent")).join(single, "class")
    return each.groupBy("antecedent", "verdict").agg(
        *[F.first(c).alias(c) for c in ("confidence", "lift", "rows", "z")],
        F.min_by("class", F.struct("freq", "class")).alias("class"),
    )


def judge(
    pages: DataFrame,
    labels: DataFrame,
    *,
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_confidence: float = 0.0,
    min_rows: int = 20,
    alpha: float = 0.05,
    default: str = "allow",
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and ``mined`` to every row of ``pages``.

    ``rules`` are a parameter of a few entries; the longest that fits decides. Where none
    fits, the most significant mined rule that matches decides (highest z; ties: confidence, rows, verdict, then the
    antecedent), and without any, ``default``. ``mined`` is that rule's antecedent, else null. See ``mine`` for the pruning by
    ``min_rows``, ``min_confidence`` and ``alpha``: evidence is counted in rows, so more rows take no rule away.

    ``labels`` (page_id, label) hold "block" or "allow" for some pages; null labels are left out. Mined rules are matched by
    an inverted index: every rule is listed under its rarest token class, the distinct token sets are
    exploded and joined with it, and the other classes of a rule are tested in place. Urls with the same
    tokens are judged once; pages meet the written verdicts by broadcast if these are few, else by a join of two plain
    shuffles, whose hot keys AQE splits.

    A null url, or one without ``://``, has no tokens and gets the default; empty tables and
    tables without labels work. Columns named like an output are replaced; rows, repeated ones too, keep their number. The
    cost of a url is linear in its length but for the rules that its tokens match.
    """
    added = ("host", "path", "rule", "verdict", "mined")
    host, path, query = parts(F.col("url"))
    split = pages.drop(*added).withColumns({"host": host, "path": path, "_query": query})
    split = split.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "_tokens", url_tokens(F.col("host"), F.col("path"), F.col("_query"))
    )
    labelled = materialize(
        split.select("page_id", F.col("_tokens").alias("tokens")).join(labels.where("label is not null").select("page_id", "label"), "page_id"), "url-labels"
    )
    keep = [c for c in pages.columns if c not in added]
    if labelled.isEmpty():
        found = split.withColumn("_best", F.lit(None).cast("struct<verdict:string,antecedent:array<string>>"))
    else:
        classes = materialize(classes_of(labelled, min_rows), "url-classes")
        index = mine(labelled, classes, min_rows, min_confidence, alpha)
        sets = split.where(F.col("_fit").isNull()).select("_tokens").distinct()
        sets = sets.withColumn("token", F.explode("_tokens")).join(classes.select("token", "class"), "token")
        sets = sets.groupBy("_tokens").agg(F.collect_set("class").alias("_classes"))
        hits = (
            sets.withColumn("class", F.explode("_classes"))
            .join(index, "class")
            .where(F.size(F.array_except("antecedent", "_classes")) == 0)
        )
        order = F.struct("z", "confidence", "rows", "verdict", "antecedent")
        best = materialize(hits.groupBy("_tokens").agg(F.max_by(F.struct("verdict", "antecedent"), order).alias("_best")), "url-verdicts")
        found = split.join(F.broadcast(best) if best.count() <= broadcast_rows else best, "_tokens", "left")
    return found.select(
        *keep,
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", F.when(F.col("_fit").isNull(), F.col("_best.verdict")), F.lit(default)).alias("verdict"),
        F.when(F.col("_fit").isNull(), F.col("_best.antecedent")).alias("mined"),
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: a page is to be blocked if the label row of its id has quality 0 or toxic 1."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.when(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))), "block")
        .otherwise("allow")
        .alias("label")
    )
    judged = judge(pages, labels)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"))
