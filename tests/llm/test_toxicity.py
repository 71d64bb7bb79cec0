"""Toxicity: planted insults, misspellings, gradients of the right sign, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from regionledger.llm import toxicity, words


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(600)]
    bad = ["grumpzork", "vilkrast", "dumbletwit"]
    rows = []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(3, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randint(0, len(w)), rng.choice(bad))
        rows.append((" ".join(w), toxic))
    return rows


def scored(model, texts):
    return np.concatenate([toxicity.scores(model, w) for _, _, w in words.chunks(pa.array(texts, pa.large_string()), lower=True)])


def test_held_out_documents_and_misspellings():
    rows = corpus(800, 1)
    model = toxicity.train([t for t, _ in rows[:600]], np.array([y for _, y in rows[:600]]))
    held = rows[600:]
    s = scored(model, [t for t, _ in held])
    y = np.array([y for _, y in held])
    assert (s[y] >= toxicity.THRESHOLD).mean() > 0.95
    assert (s[~y] >= toxicity.THRESHOLD).mean() < 0.02
    odd = scored(model, ["le grumpzorks ba", "so vilkrasst ta", "baba lele nono", "", "DUMBLETWITS"])
    assert odd[0] > 0.5 and odd[1] > 0.5 and odd[4] > 0.5 and odd[2] < 0.5
    # One insult in a very long text counts as in a short one.
    clean = " ".join(t for t, y in rows if not y)
    long = scored(model, [clean, clean + " grumpzork " + clean])
    assert long[0] < toxicity.THRESHOLD <= long[1]
    assert scored(toxicity.train([], np.zeros(0, bool)), ["x", ""]).tolist() == [0.5, 0.5]


def test_subwords_do_not_cross_words():
    w = next(words.chunks(pa.array(["ab cd", "cd ab"]), lower=True))[2]
    buckets, bounds, which = toxicity.subwords(w)
    per = [sorted(buckets[bounds[k] : bounds[k + 1]].tolist()) for k in which]
    # Marks count: <ab> has two 3-grams, one 4-gram and the word itself.
    assert per[0] == per[3] and per[1] == per[2] and len(per[0]) == 4


def test_rows_and_training_split(spark):
    rows = corpus(300, 2)
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, (t, _) in enumerate(rows)] + [(None, None, None, 1.0), (7, rows[7][0], "en", 0.5), (9000, "", "en", 0.1)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, int(y)) for i, (_, y) in enumerate(rows)] + [(None, 1), (9000, None)], "doc_id long, toxic int")
    held = {r.doc_id for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()}
    assert held == {i for i in [*range(300), 9000] if zlib.crc32(str(i).encode()) % 3 == 1}
    model = toxicity.fit(docs, labels)
    # Labels of held-out documents change nothing.
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.array_equal(toxicity.fit(docs, other).pull, model.pull)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 303 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 7}) == 1
    assert len({r.score for r in got if r.doc_id in (None, 9000)}) == 1
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert toxicity.score(docs.limit(2), toxicity.fit(docs, labels.limit(0))).first().score == 0.5
