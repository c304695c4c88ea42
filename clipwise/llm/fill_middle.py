"""Fill-in-middle transformation: texts cut at two random places between units, in two passes over a lazy matcher."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The units of a text, and the marks before prefix, suffix and middle.
UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKS = ("<P>", "<S>", "<M>")


def counted(pattern: re.Pattern, text: str) -> int:
    """First pass: the number of units, none of which is kept."""
    return sum(1 for _ in pattern.finditer(text))


def ends(pattern: re.Pattern, text: str, low: int, high: int) -> tuple[int, int]:
    """Second pass: where the units of ranks ``low`` and ``high`` end (0 for rank 0); stops at the higher one."""
    matches = pattern.finditer(text)
    at = next(islice(matches, low - 1, None)).end() if low else 0
    return at, next(islice(matches, high - low - 1, None)).end() if high > low else at


def cuts(pattern: str) -> Column:
    """A function of text and two draws: its number of units, and the code points of prefix and middle (null without draws).

    A text of n units is cut after the draws' remainders by n + 1.
    """
    compiled = re.compile(pattern)

    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, first, second in batches:
            units, prefix, middle = [], [], []
            for text, a, b in zip(texts, first, second, strict=True):
                s, a, b = text.as_py() or "", a.as_py(), b.as_py()
                units.append(n := counted(compiled, s))
                p, q = (None, None) if a is None or b is None else ends(compiled, s, *sorted((a % (n + 1), b % (n + 1))))
                prefix.append(p)
                middle.append(None if p is None else q - p)
            yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (units, prefix, middle)], ["n", "prefix_chars", "middle_chars"])

    cut.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(cut, "struct<n: bigint, prefix_chars: bigint, middle_chars: bigint>")


def draws(doc_id: Column, seed: str) -> list[Column]:
    """Four numbers below 2^32 from seed and id (a null id counts as an empty string)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, *, seed: str = "1", rate: int = 90, spm: int = 20, pattern: str = UNIT) -> DataFrame:
    """Adds n (units), form, output, prefix_chars and middle_chars.

    Form is plain for a share of ``100 - rate`` % of the ids, and for texts that are empty or hold a mark; their output is the text
    and their counts are null. ``spm`` % of the others are spm (suffix, prefix, middle), the rest psm (prefix, suffix, middle).
    The draws depend on seed and id alone, so repeated rows come out alike. ``pattern`` should match every code point; what it
    leaves between two units goes with the later one.

    A text is walked twice by a lazy matcher, of which one match at a time is held: memory is the text's own, however long. Rows are
    independent, and nothing is shuffled. Null texts count as empty, null ids as an empty string; an empty table gives no rows,
    and columns of ``docs`` named like an output are replaced.
    """
    added = ("n", "form", "output", "prefix_chars", "middle_chars")
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = F.contains(text, F.lit(MARKS[0])) | F.contains(text, F.lit(MARKS[1])) | F.contains(text, F.lit(MARKS[2]))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    rest = [c for c in docs.columns if c not in (*added, "text")]
    formed = docs.select(F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("_rest"), F.col("text").alias("_text"), text.alias("_t"), form.alias("form"), h1.alias("_h1"), h2.alias("_h2"))
    asked = lambda c: F.when(F.col("form") != "plain", F.col(c))
    cut = formed.withColumn("_c", cuts(pattern)("_t", asked("_h1"), asked("_h2"))).select("*", "_c.*")
    a, m, t = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int"), F.col("_t")
    prefix, middle, suffix = F.substring(t, F.lit(1), a), F.substring(t, a + 1, m), F.substring(t, a + m + 1, F.length(t))
    marks = dict(zip("psm", map(F.lit, MARKS), strict=True))
    psm = F.concat(marks["p"], prefix, marks["s"], suffix, marks["m"], middle)
    spm_ = F.concat(marks["s"], suffix, marks["p"], prefix, marks["m"], middle)
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm_).otherwise(t)
    own = [F.col("_text").alias(c) if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns if c not in added]
    return cut.select(*own, "n", "form", output.alias("output"), "prefix_chars", "middle_chars")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No mark occurs in a part, nor can one begin in a part and end in a mark."""
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1) if a else output, b, 1) if b else F.substring_index(output, a, -1)
    p, s, m = MARKS
    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


_H = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"

OP12_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
f AS (SELECT doc_id, t, u, len(u) AS n, least({_H.format(1)} % (len(u) + 1), {_H.format(9)} % (len(u) + 1)) AS lo,
             greatest({_H.format(1)} % (len(u) + 1), {_H.format(9)} % (len(u) + 1)) AS hi,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_H.format(17)} % 100 >= 90 THEN 'plain'
                  WHEN {_H.format(25)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
