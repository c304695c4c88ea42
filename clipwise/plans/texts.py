"""Queries over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwise.functions import text as T
from clipwise.functions.numbers import rounded
from clipwise.operators import gates, timeline
from clipwise.sources.io import looks_like_header

from .base import query, table

#: A lexicon of our own for the share of everyday English words.
LEXICON = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "at", "by", "this", "from", "or", "an", "not"]
_LIST = ", ".join(f"'{w}'" for w in LEXICON)
_SP = T.SPACE
_NP = "[" + _SP[1:-1] + "]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SP}+|{_SP}+$', '', 'g')"


def sql_transliterate(x: str) -> str:
    x = f"regexp_replace({x}, '\\[[^\\]]*\\]', '', 'g')"
    for k, v in T.ASCII_OF.items():
        x = f"replace({x}, '{k}', '{v}')"
    return sql_strip(f"regexp_replace({x}, '{_SP}{{2,}}', ' ', 'g')")


def sql_words(x: str) -> str:
    s = sql_strip(f"coalesce({x}, '')")
    return f"(CASE WHEN {s} = '' THEN 0 ELSE len(regexp_split_to_array({s}, '{_SP}+')) END)"


_REPORT_SQL = f"""
r AS (
  SELECT doc_id, source, ascii, words, wps, leftover, array_to_string(list_filter([
      CASE WHEN words < 20 THEN printf('few_words(%d)', words) END,
      CASE WHEN wps < 2.0 THEN printf('low_wps(%.2f)', wps) END,
      CASE WHEN wps > 4.0 THEN printf('high_wps(%.2f)', wps) END,
      CASE WHEN leftover > 0.05 THEN printf('non_ascii(%.2f)', leftover) END], lambda x: x IS NOT NULL), ';') AS reasons
  FROM (SELECT *, CASE WHEN length(text) > 0 THEN words / (length(text) / 15.0) ELSE 0.0 END AS wps,
               CASE WHEN length(ascii) > 0 THEN len(regexp_extract_all(ascii, '[^\\x00-\\x7F]')) / CAST(length(ascii) AS DOUBLE) ELSE 0.0 END AS leftover
        FROM (SELECT *, {sql_transliterate('text')} AS ascii, CAST({sql_words('text')} AS INTEGER) AS words FROM documents)))
"""


def document_report(docs: DataFrame) -> DataFrame:
    """Gate report of texts, 15 characters standing for a second."""
    ascii_ = T.transliterate(F.col("text"))
    measured = docs.select("doc_id", "source", "text", ascii_.alias("ascii"), T.word_count(F.col("text")).alias("words"))
    wps = F.coalesce(F.try_divide(F.col("words"), F.length("text") / F.lit(15.0)), F.lit(0.0))
    leftover = F.coalesce(F.try_divide(F.size(T.non_ascii(F.col("ascii"))), F.length("ascii").cast("double")), F.lit(0.0))
    measured = measured.withColumns({"wps": wps, "leftover": leftover})
    rules = T.reasons(
        (F.col("words") < 20, F.format_string("few_words(%d)", "words")),
        (F.col("wps") < 2.0, T.with_value("low_wps", F.col("wps"))),
        (F.col("wps") > 4.0, T.with_value("high_wps", F.col("wps"))),
        (F.col("leftover") > 0.05, T.with_value("non_ascii", F.col("leftover"))),
    )
    return measured.withColumn("_r", rules).withColumn("status", T.status(F.col("_r"))).withColumn("reasons", F.array_join("_r", ";")).drop("_r")


@query("doc_gate_report", f"WITH {_REPORT_SQL} SELECT doc_id, words, round(wps, 4) AS wps, CASE WHEN reasons = '' THEN 'PASS' ELSE 'FAIL' END AS status, reasons FROM r")
def doc_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_report(table(spark, sf_dir, "documents")).select("doc_id", "words", rounded("wps", 4).alias("wps"), "status", "reasons")


@query("gate_reason_histogram", f"WITH {_REPORT_SQL} SELECT split_part(x, '(', 1) AS reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ';')) AS x FROM r) WHERE x <> '' GROUP BY 1")
def gate_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.reason_histogram(document_report(table(spark, sf_dir, "documents")))


@query("transliterate_docs", f"SELECT doc_id, {sql_transliterate('text')} AS ascii FROM documents")
def transliterate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.transliterate(F.col("text")).alias("ascii"))


_CLEAN = sql_strip(f"regexp_replace(regexp_replace({sql_transliterate('text')}, '{_SP}+([,.?!;:])', '\\1', 'g'), '{_SP}+', ' ', 'g')")


@query("clean_docs", f"SELECT doc_id, {_CLEAN} AS clean FROM documents")
def clean_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query("ascii_residue", f"SELECT c, count(*) AS n FROM (SELECT unnest(regexp_extract_all({sql_transliterate('text')}, '[^\\x00-\\x7F]')) AS c FROM documents) GROUP BY c")
def ascii_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "documents").select(F.explode(T.non_ascii(T.transliterate(F.col("text")))).alias("c"))
    return left.groupBy("c").agg(F.count("*").alias("n"))


@query(
    "english_fraction",
    f"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z'']+') AS ts FROM documents)
SELECT doc_id, len(ts) AS n_tokens, round(CASE WHEN len(ts) > 0 THEN len(list_filter(ts, lambda x: x IN ({_LIST}))) / CAST(len(ts) AS DOUBLE) ELSE 0.0 END, 6) AS english FROM t""",
)
def english_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("ts"))
    return docs.select("doc_id", F.size("ts").cast("long").alias("n_tokens"), rounded(T.share_of(F.col("ts"), LEXICON), 6).alias("english"))


@query(
    "token_ratios",
    """WITH t AS (SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+')) AS n, len(regexp_extract_all(text, '[A-Za-z]+''[A-Za-z]+')) AS a,
       len(regexp_extract_all(text, '[A-Za-z]+-[A-Za-z]+')) AS h FROM documents)
SELECT doc_id, round(CASE WHEN n > 0 THEN a / CAST(n AS DOUBLE) ELSE 0.0 END, 6) AS apostrophes, round(CASE WHEN n > 0 THEN h / CAST(n AS DOUBLE) ELSE 0.0 END, 6) AS hyphens FROM t""",
)
def token_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        rounded(T.pattern_ratio(c, "[A-Za-z]+", "[A-Za-z]+'[A-Za-z]+"), 6).alias("apostrophes"),
        rounded(T.pattern_ratio(c, "[A-Za-z]+", "[A-Za-z]+-[A-Za-z]+"), 6).alias("hyphens"),
    )


@query(
    "line_lint",
    r"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT count(*) AS lines, count(*) FILTER (WHERE regexp_matches(line, '[0-9]')) AS with_digits,
       count(*) FILTER (WHERE regexp_matches(line, '^\s*[A-Z][A-Za-z .]{1,30}:')) AS headers,
       count(*) FILTER (WHERE regexp_matches(line, '[.?!]\s*$')) AS sentence_ends FROM l""",
)
def line_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    line = F.col("line")
    return lines.agg(
        F.count("*").alias("lines"), F.count_if(line.rlike("[0-9]")).alias("with_digits"), F.count_if(looks_like_header(line)).alias("headers"), F.count_if(T.ends_sentence(line)).alias("sentence_ends")
    )


def _sql_strip_tags(x: str) -> str:
    x = f"regexp_replace(regexp_replace({x}, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g')"
    for k, v in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{k}', '{v}')"
    return sql_strip(f"regexp_replace({x}, '[ \\t]+', ' ', 'g')")


@query(
    "html_paragraphs",
    f"""WITH p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?is)<p\\b[^>]*[^>]*>(.*?)</p>', 1), lambda x: {_sql_strip_tags('x')}), lambda x: x <> '') AS ps FROM pages)
SELECT page_id, len(ps) AS n_paragraphs, md5(array_to_string(ps, chr(10) || chr(10))) AS text_md5 FROM p""",
)
def html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", T.paragraphs(F.col("html")).alias("ps"))
    return pages.select("page_id", F.size("ps").cast("long").alias("n_paragraphs"), F.md5(F.array_join("ps", "\n\n")).alias("text_md5"))


_Q = "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"


@query(
    "page_slug",
    f"""WITH s AS (SELECT page_id, lower(regexp_replace(regexp_replace(regexp_replace(url_decode(replace(split_part({_Q}, '&a_id', 1), '+', '%2B')), '^\\d+-+', ''), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM pages)
SELECT page_id, CASE WHEN slug = '' THEN 'lecture' ELSE slug END AS slug FROM s""",
)
def page_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


@query(
    "filename_decode",
    r"""WITH f AS (SELECT conv_id, turn, 'out/c' || conv_id || '__' || role || '__s' || turn || '.wav' AS path FROM conversations)
SELECT path, regexp_extract(path, '([^/]+)$', 1) AS name, CAST(regexp_extract(path, 'c(\d+)__(\w+?)__s(\d+)\.wav$', 1) AS BIGINT) AS ckpt,
       regexp_extract(path, 'c(\d+)__(\w+?)__s(\d+)\.wav$', 2) AS sent, CAST(regexp_extract(path, 'c(\d+)__(\w+?)__s(\d+)\.wav$', 3) AS INTEGER) AS seed FROM f""",
)
def filename_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clipwise.sources.io import from_name

    path = F.concat(F.lit("out/c"), "conv_id", F.lit("__"), "role", F.lit("__s"), "turn", F.lit(".wav"))
    files = table(spark, sf_dir, "conversations").select(path.alias("path")).withColumn("name", T.basename(F.col("path")))
    return files.select("path", "name", *from_name(F.col("name"), r"^c(\d+)__(\w+?)__s(\d+)\.wav$", {"ckpt": "bigint", "sent": "string", "seed": "int"}))


@query(
    "speaker_turn_filter",
    """WITH f AS (SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 OR role = 'system' THEN role END AS header FROM conversations),
g AS (SELECT *, coalesce(last_value(header IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 'assistant') AS speaker FROM f)
SELECT conv_id, turn, length(text) AS n FROM g WHERE speaker <> 'user'""",
)
def speaker_turn_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker labels on some turns only, carried forward; the turns of all but one speaker are kept."""
    labelled = table(spark, sf_dir, "conversations").withColumn("header", F.when((F.col("turn") % 2 == 0) | (F.col("role") == "system"), F.col("role")))
    speaker = F.coalesce(timeline.forward_fill(labelled, "header", "turn", keys=("conv_id",)), F.lit("assistant"))
    return labelled.withColumn("speaker", speaker).where("speaker <> 'user'").select("conv_id", "turn", F.length("text").cast("long").alias("n"))


@query(
    "speaker_runs",
    """WITH f AS (SELECT *, role <> 'user' AS t FROM conversations),
g AS (SELECT *, sum(CASE WHEN t THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT conv_id, CAST(run AS BIGINT) AS run, count(*) AS n, md5(string_agg(text, ' ' ORDER BY turn)) AS text_md5 FROM g WHERE t GROUP BY conv_id, run""",
)
def speaker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = table(spark, sf_dir, "conversations").withColumn("is_target", F.col("role") != "user")
    found = timeline.runs(flagged, "is_target", "turn", keys=("conv_id",))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ")
    return found.groupBy("conv_id", "run").agg(F.count("*").alias("n"), F.md5(joined).alias("text_md5"))


@query("speaker_talk", "SELECT role, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT conv_id) AS conversations FROM conversations GROUP BY role")
def speaker_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"), F.count_distinct("conv_id").alias("conversations"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark text against the one before it, as reference and hypothesis."""
    rows = table(spark, sf_dir, "benchmark").select((F.col("item_id") + 1).alias("item_id"), F.col("text").alias("hyp"))
    return table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("ref")).join(rows, "item_id")


#: DuckDB's levenshtein counts bytes, so its SQL maps the letters that lower-cased texts have beyond ASCII to free ASCII characters.
_BEYOND, _FREE = "àâäáãåæçéèêëíìîïñóòôöõøœßúùûüÿ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&"
_NORM = "translate(trim(regexp_replace(regexp_replace(lower({x}), '\\p{{P}}', '', 'g'), '\\s+', ' ', 'g')), '" + _BEYOND + "', '" + _FREE + "')"


def _sql_cer(r: str, h: str) -> str:
    a, b = _NORM.format(x=r), _NORM.format(x=h)
    return f"CASE WHEN {sql_strip(r)} = '' THEN 0.0 WHEN {sql_strip(h)} = '' THEN 1.0 WHEN {a} = '' THEN 0.0 ELSE levenshtein({a}, {b}) / CAST(length({a}) AS DOUBLE) END"


_PAIRS_SQL = "p AS (SELECT a.item_id, a.text AS r, b.text AS h FROM benchmark a JOIN benchmark b ON a.item_id = b.item_id + 1)"


@query("cer_pairs", f"WITH {_PAIRS_SQL} SELECT item_id, round({_sql_cer('r', 'h')}, 6) AS cer FROM p")
def cer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("item_id", rounded(T.cer(F.col("ref"), F.col("hyp")), 6).alias("cer"))


@query(
    "wer_pairs",
    f"""WITH RECURSIVE {_PAIRS_SQL},
s AS (SELECT item_id, list_filter(regexp_split_to_array(regexp_replace(lower(r), '[^\\p{{L}}\\p{{N}}_\\s'']', '', 'g'), '\\s+'), lambda x: x <> '') AS r,
             list_filter(regexp_split_to_array(regexp_replace(lower(h), '[^\\p{{L}}\\p{{N}}_\\s'']', '', 'g'), '\\s+'), lambda x: x <> '') AS h FROM p),
d AS (SELECT item_id, CAST(0 AS BIGINT) AS i, range(0, len(h) + 1) AS line FROM s
  UNION ALL
  SELECT item_id, i, list_transform(range(0, len(best)), lambda j: j + list_min(list_transform(range(0, j + 1), lambda k: best[k + 1] - k)))
  FROM (SELECT d.item_id, d.i + 1 AS i, list_transform(range(0, len(d.line)), lambda j: CASE WHEN j = 0 THEN d.i + 1 ELSE least(d.line[j + 1] + 1, d.line[j] + CASE WHEN s.r[d.i + 1] = s.h[j] THEN 0 ELSE 1 END) END) AS best
        FROM d JOIN s ON s.item_id = d.item_id WHERE d.i < len(s.r)))
SELECT s.item_id, round(CASE WHEN len(s.r) = 0 OR len(s.h) = 0 THEN 1.0 ELSE d.line[len(s.h) + 1] / CAST(len(s.r) AS DOUBLE) END, 6) AS wer FROM s JOIN d ON d.item_id = s.item_id AND d.i = len(s.r)""",
)
def wer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clipwise.functions.edits import wer

    return _pairs(spark, sf_dir).select("item_id", rounded(wer(F.col("ref"), F.col("hyp")), 6).alias("wer"))


@query(
    "core_error_rates",
    f"""WITH {_PAIRS_SQL}, b AS (SELECT *, array_to_string(list_filter(regexp_extract_all(lower(r), '[a-z'']+'), lambda x: x IN ({_LIST})), ' ') AS rc,
  array_to_string(list_filter(regexp_extract_all(lower(h), '[a-z'']+'), lambda x: x IN ({_LIST})), ' ') AS hc FROM p),
e AS (SELECT item_id, {sql_strip('h')} = '' AS blank, {_sql_cer('r', 'h')} AS raw, CASE WHEN rc <> '' THEN {_sql_cer('rc', 'hc')} END AS core FROM b)
SELECT item_id, round(CASE WHEN blank THEN 1.0 ELSE raw END, 6) AS cer_raw, round(CASE WHEN blank THEN 1.0 ELSE core END, 6) AS cer_core, round(CASE WHEN blank THEN 0.0 ELSE raw - core END, 6) AS load FROM e""",
)
def core_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = T.error_rates(F.col("ref"), F.col("hyp"), LEXICON)
    return _pairs(spark, sf_dir).select("item_id", rates.alias("e")).select("item_id", *[rounded(f"e.{c}", 6).alias(c) for c in ("cer_raw", "cer_core", "load")])


@query(
    "stopword_lexicon",
    "SELECT w AS word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS w FROM documents) WHERE w IN (" + _LIST + ") GROUP BY w",
)
def stopword_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership as a semi join with a lexicon table, for lexicons of any size."""
    lexicon = spark.range(1).select(F.explode(F.array(*map(F.lit, LEXICON))).alias("word"))
    each = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("word"))
    return each.join(F.broadcast(lexicon), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(
    "longest_per_source",
    """SELECT source, doc_id, n FROM (SELECT source, doc_id, length(text) AS n, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS k FROM documents) WHERE k <= 3""",
)
def longest_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.length("text").cast("long").alias("n"))
    order = Window.partitionBy("source").orderBy(F.desc("n"), "doc_id")
    return rows.withColumn("k", F.row_number().over(order)).where("k <= 3").drop("k")
