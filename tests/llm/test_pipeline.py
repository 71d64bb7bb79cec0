"""Each stage of the pipeline against a brute-force version on its own input."""

import math

import pytest
from test_jaccard import shingles
from test_quality import brute as statistics
from test_templates import brute as leaks

import corpus_pipeline
from regionledger.llm import quality, registry

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows(df):
    return sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return registry.table(spark, SF, "documents").cache()


def test_stages_and_columns(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontaminate", "mix_sources", "shard"]
    for name, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, SF).columns == COLUMNS
        assert f(spark, docs.limit(0), SF).collect() == []


def test_quality_rules(spark, docs):
    rules = quality.fit(docs, registry.table(spark, SF, "labels"))
    want = []
    for r in docs.collect():
        s = dict(zip(["n_words", "word_chars", "n_symbols", "n_upper", "n_marks", "n_lines", "n_dup_lines", "n_distinct", "n_repeat_words"], statistics(r.text)))
        x = {k: eval(e.replace("/", "*1.0/"), {}, s) if s["n_words"] else 0.0 for k, e in quality.FEATURES.items()}  # noqa: S307
        bad = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
        bad = bad or any(all((x[c.feature] > c.threshold) == c.above for c in rule) for rule in rules)
        if not bad:
            want.append(tuple(r))
    assert rows(stage("quality_rules")(spark, docs, SF)) == sorted(want, key=repr)


def test_near_duplicates(spark, docs):
    every = [tuple(r) for r in docs.collect()]
    sets = [shingles(r[1], 5) for r in every]
    up = list(range(len(every)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, r in enumerate(every):
        least[find(i)] = min(r, least.get(find(i), r), key=lambda x: x[0])
    assert rows(stage("near_duplicates")(spark, docs, SF)) == sorted(least.values(), key=repr)


def test_decontaminate(spark, docs):
    items = [tuple(r) for r in registry.table(spark, SF, "benchmark").collect()]
    hit = {d for d, x in leaks([(r.doc_id, r.text) for r in docs.collect()], items) if x}
    assert hit
    assert rows(stage("decontaminate")(spark, docs, SF)) == sorted((tuple(r) for r in docs.collect() if r.doc_id not in hit), key=repr)


def test_mix_sources(spark, docs):
    got = rows(stage("mix_sources")(spark, docs, SF))
    every = [tuple(r) for r in docs.collect()]
    assert set(got) == set(every)
    count = lambda x, s: sum(len((r[1] or "").split()) for r in x if r[3] == s)
    passes = {s: count(got, s) / count(every, s) for s in {r[3] for r in every}}
    biggest = max(passes, key=lambda s: count(every, s))
    assert passes[biggest] == 1.0
    # The smallest source is passed as often as the limit allows, up to its last document.
    smallest = min(passes, key=lambda s: count(every, s))
    longest = max(len((r[1] or "").split()) for r in every if r[3] == smallest)
    assert abs(passes[smallest] - registry.REPETITION_LIMIT) <= longest / count(every, smallest) + 1e-6
    assert all(p <= registry.REPETITION_LIMIT + 1 for p in passes.values())


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert got
    loads = [0] * 16
    for r in got:
        loads[r.shard] += r["size"]
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    groups = {(r.text_crc32, r["size"]): r.shard for r in got}
    assert all(groups[(r.text_crc32, r["size"])] == r.shard for r in got)
    largest = max(r["size"] * sum(x.text_crc32 == r.text_crc32 for x in got) for r in got)
    assert max(loads) <= max(largest, math.ceil(sum(loads) / 16) + largest)
