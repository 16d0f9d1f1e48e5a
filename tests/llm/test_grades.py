"""Held-out shares that the quality classifier keeps, per grade and language."""

from collections import Counter

import pyarrow as pa
from flowlake.llm.quality import grade_documents, hashed_features, train_quality
from flowlake.llm.queries import graded_labels
from pyspark.sql import functions as F

TABLES = "/root/testdata/sf0.1"


def test_held_out_grades_of_every_language(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    ratings = graded_labels(spark, TABLES)
    # Documents that begin alike, as copies do, are all held out or none is.
    side = docs.select("doc_id", "lang", "text", (F.pmod(F.xxhash64(F.left("text", F.lit(60))), F.lit(4)) == 0).alias("held"))
    model = train_quality(docs, ratings.join(side.where(~F.col("held")), "doc_id").select("doc_id", "grade"))
    held = side.where("held").join(ratings, "doc_id").select("doc_id", "text", "lang", "grade")
    graded = grade_documents(held, model).select("doc_id", "kept").distinct()
    rows = held.drop("text").distinct().join(graded, "doc_id").collect()
    every, kept = Counter(), Counter()
    for r in rows:
        for key in (r.grade, (r.lang, r.grade)):
            every[key] += 1
            kept[key] += r.kept
    shares = {key: f"{kept[key]}/{n}" for key, n in sorted(every.items(), key=str)}
    print("kept of held-out documents:", shares)
    assert every[1] > 60 and kept[1] / every[1] < 0.15, shares
    assert kept[0] / every[0] < 0.04 and kept[2] / every[2] > 0.97, shares
    toxic = [(lang, 1) for lang in ("de", "fr", "es")]
    assert sum(kept[k] for k in toxic) / sum(every[k] for k in toxic) < 0.25, shares


def test_long_words_share_their_beginning():
    def features(text):
        return set(hashed_features(pa.array([text], pa.large_string()))[1].tolist())

    assert len(features("öäüßen") & features("öäüßan")) == 2  # first four letters, and shape
    assert len(features("achlichkeit") & features("achlichung,")) == 2  # first four and six
    assert len(features("öäüß") & features("öäüßen")) == 1  # shape only
