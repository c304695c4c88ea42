"""Table function, set-aside groups, sentences, factors, resumable jobs and character references."""

import html
import random
from html.entities import html5

import numpy as np
import pytest
from clipwise.functions import clips
from clipwise.functions import text as T
from clipwise.operators import factors, quarantine, sentences, timeline
from clipwise.streaming import resumable
from pyspark.sql import functions as F


def test_clips_by_sql_equal_the_fold(spark):
    rnd, rows = random.Random(3), []
    for lecture in (1, 2, 3, None):
        t = 0.0
        for i in range(60):
            t += rnd.random() * 2
            rows.append((lecture, i, t, t + rnd.random() * 6, rnd.random() < 0.3))
    words = spark.createDataFrame(rows, "lecture int, id long, start double, end double, stops boolean")
    clips.register(spark)
    sql = "SELECT * FROM clips_of(TABLE({words}) PARTITION BY lecture ORDER BY (start, `end`, id))"
    got = sorted(map(repr, map(tuple, spark.sql(sql, words=words).collect())))
    assert got == sorted(map(repr, map(tuple, timeline.greedy_clips(words).collect()))) and got
    whole = spark.sql("SELECT * FROM clips_of(TABLE({words}) WITH SINGLE PARTITION ORDER BY (start, `end`, id), keys => '', most => 5D, least => 4D)", words=words.where("lecture = 1"))
    assert whole.columns == ["first", "last", "start", "end"] and whole.count() > 5
    assert spark.sql(sql, words=words.where("false")).count() == 0
    with pytest.raises(Exception, match="needs the columns stops"):
        spark.sql(sql, words=words.drop("stops"))


def test_one_broken_lecture_changes_one_row(spark):
    rows = [(k, i, float(i)) for k in range(6) for i in range(4)]
    schema = "lecture int, id int, x double"

    def work(group):
        if group["x"].isna().any():
            raise ValueError("no x")
        return group.groupby("lecture", as_index=False).agg(total=("x", "sum"))[["total"]]

    whole = quarantine.isolated(spark.createDataFrame(rows, schema), ["lecture"], work, "total double")
    broken = [(k, i, None if (k, i) == (2, 1) else x) for k, i, x in rows]
    out = quarantine.isolated(spark.createDataFrame(broken, schema), ["lecture"], work, "total double")
    results = lambda r: {x.lecture: x.total for x in r.results.collect()}
    assert results(whole) == {k: 6.0 for k in range(6)} and whole.flagged.count() == 0
    assert results(out) == {k: 6.0 for k in range(6) if k != 2}
    assert [tuple(r) for r in out.flagged.collect()] == [(2, "error:no x", 4)]
    assert whole.counts == {"results": 6, "groups": 6, "flagged": 0} and out.counts == {"results": 5, "groups": 5, "flagged": 1}
    wrong = quarantine.isolated(spark.createDataFrame(rows, schema), ["lecture"], lambda g: g[["id"]], "total double")
    assert wrong.results.count() == 0 and wrong.flagged.count() == 6
    none = quarantine.isolated(spark.createDataFrame([], schema), ["lecture"], work, "total double")
    assert none.counts["groups"] == 0 and none.results.columns == ["lecture", "total"]


#: Shares, runs and tags of the retired classifier's report.
TAGGED = [
    (0.50, 4, False, "frac>=0.5"),
    (0.72, 11, False, "frac>=0.5"),
    (0.44, 11, True, "verse(run>=4+cited)"),
    (0.38, 4, True, "verse(run>=4+cited)"),
    (0.27, 8, False, "run>=7"),
    (0.44, 6, False, ""),
    (0.09, 1, False, ""),
]
ENGLISH = "one who is intelligent really should give up this he take all such care how can i develop says lord instruction in the fifth canto of base material world it based on and what oh"
#: Sentences of that report, with their shares in two places and their runs.
MEASURED = [
    ("One who is intelligent, really intelligent, should give up this maya-moha.", 0.09, 1, False),
    ("He should take all such care; how can I develop this krishna-bhakti?", 0.08, 1, False),
    ("pumsah striya mithuni-bhavam etam, Bhagavata says, this is Lord Rishabhadevas instruction in the fifth canto of Shrimad Bhagavatam.", 0.44, 5, False),
    ("This is the base of the material world, pumsah striya mithuni-bhavam etam.", 0.33, 4, False),
    ("This is based on the maithuna of purusha and stri.", 0.30, 1, False),
    ("ato gṛha, kṣetra, suta.", 1.00, 4, False),
    ("Oh Kṛṣṇa!", 0.50, 1, False),
]


def test_the_retired_classifier(spark):
    got = spark.createDataFrame(TAGGED, "f double, r int, c boolean, tag string").select("tag", sentences.reason(F.col("f"), F.col("r"), F.col("c")).alias("why"), sentences.kind(F.col("f"), F.col("r"), F.col("c")).alias("kind")).collect()
    assert all(r.tag == r.why and (r.kind == "KEEP") == (r.tag == "") for r in got)
    lexicon = spark.createDataFrame([(w,) for w in ENGLISH.split()], "word string")
    more = [("He said so [Song: Xyz abc].", 0.5, 1, True), ("they [when] unite [verse]", 1.0, 2, True), ("[laughter]", 0.0, 0, False), ("", 0.0, 0, False), (None, 0.0, 0, False)]
    rows = spark.createDataFrame([(i, s) for i, (s, *_) in enumerate(MEASURED + more)], "k int, sentence string")
    for limit in (0, 100):
        found = {r.k: r for r in sentences.foreign_runs(rows, lexicon, keys=("k",), broadcast_rows=limit).collect()}
        for k, (s, f, r, cited) in enumerate(MEASURED + more):
            if s and s.startswith("He said"):
                f, r = 2 / 3, 2
            assert (round(found[k].f, 2), found[k].r, found[k].cited) == (round(f, 2), r, cited), s


def test_sentences_of_a_text(spark):
    docs = spark.createDataFrame([(1, "One. Two!\nThree? 4.5 is one"), (2, None), (3, "")], "doc_id int, text string")
    assert [(r.doc_id, r.nr, r.sentence) for r in sentences.split_sentences(docs).orderBy("doc_id", "nr").collect()] == [(1, 0, "One"), (1, 1, "Two"), (1, 2, "Three"), (1, 3, "4.5 is one"), (3, 0, "")]


def test_factors_beat_biases(spark):
    rnd = np.random.default_rng(7)
    p, q, bu, bi = rnd.standard_normal((60, 3)), rnd.standard_normal((50, 3)), rnd.standard_normal(60), rnd.standard_normal(50)
    cells = [(u, i, float(3 + bu[u] + bi[i] + p[u] @ q[i] + 0.05 * rnd.standard_normal())) for u in range(60) for i in range(50) if rnd.random() < 0.6]
    held = set(rnd.choice(len(cells), len(cells) // 10, replace=False).tolist())
    schema = "user long, item long, rating double"
    train = spark.createDataFrame([c for k, c in enumerate(cells) if k not in held] + [(None, 1, 1.0), (1, None, 1.0), (1, 1, None)], schema)
    test = spark.createDataFrame([c for k, c in enumerate(cells) if k in held], schema)
    model = factors.fit(train, rank=3, ridge=0.02, rounds=12)
    e = factors.errors(test, model).first()
    assert e.n == len(held) and e.factor_rmse < 0.5 * e.bias_rmse
    again = factors.errors(test, factors.fit(train, rank=3, ridge=0.02, rounds=12)).first()
    assert abs(again.factor_rmse - e.factor_rmse) < 1e-3
    unknown = factors.predict(spark.createDataFrame([(999, 999)], "user long, item long"), model).first()
    assert unknown.by_bias == unknown.by_factors == pytest.approx(model.mean)
    none = factors.fit(train.where("false"))
    assert none.mean == 0.0 and none.users.count() == 0


def test_a_crash_before_the_checkpoint_leaves_no_job_twice(spark, tmp_path):
    schema = "ckpt int, seed int"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    def work(jobs):
        return jobs.withColumn("score", F.col("ckpt") * 10 + F.col("seed"))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        return resumable.resume(spark, stream, out, f"{tmp_path}/state", ["ckpt", "seed"], work, f"{schema}, score int")

    put([(1, 1), (1, 2), (1, 2)])
    assert run().count() == 2
    put([(1, 2), (2, 1)])
    # The batch is written, and the driver dies before the checkpoint has it.
    commit = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def dies(batch, number):
        before = resumable.done(spark, out, f"{schema}, score int").where(F.col("batch") < number).select("ckpt", "seed")
        work(batch.dropDuplicates(["ckpt", "seed"]).join(before, ["ckpt", "seed"], "left_anti")).write.mode("overwrite").parquet(f"{out}/batch={number}")
        raise RuntimeError("lost after the write")

    query = commit.writeStream.foreachBatch(dies).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost after the write"):
        query.awaitTermination()
    assert resumable.done(spark, out, f"{schema}, score int").count() == 3
    put([(3, 3), (2, 1)])
    rows = sorted((r.ckpt, r.seed, r.score) for r in run().collect())
    assert rows == [(1, 1, 11), (1, 2, 12), (2, 1, 21), (3, 3, 33)]
    assert run().count() == 4


def test_all_character_references(spark):
    rnd = random.Random(2)
    pieces = ["&", "#", "x", "amp", "lt;", "&lt", "&#38;", "&#x26;", "&#X1F600", "&notit;", "&notin;", "&#128;", "&#0;", "&#xD800;", "&#1114112;", "&#65534;", "&#99999999999999999999999;", "&#x1;", "&#13;", "&#127;", " ", "\n", "é", "😀", ";", "&;", "&amp;lt;", "copy"]
    rows = [f"&{n}" for n in html5] + [f"a&{n}x" for n in html5] + ["".join(rnd.choices(pieces, k=rnd.randint(1, 9))) for _ in range(1500)] + [None, "", "&", "no marks", "&" + "a" * 40 + ";"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x string")
    got = {r.i: r.y for r in df.select("i", T.unescape(F.col("x")).alias("y")).collect()}
    assert [(x, got[i]) for i, x in enumerate(rows) if got[i] != (None if x is None else html.unescape(x))] == []
