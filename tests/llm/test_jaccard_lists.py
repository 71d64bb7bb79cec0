"""What the lists of the heavy-light join move and keep."""

from regionledger.llm import jaccard
from regionledger.sources import scratch


def tables_of(spark, monkeypatch, texts):
    kept = []
    write = scratch.materialise

    def recorded(df):
        kept.append(write(df))
        return kept[-1]

    monkeypatch.setattr(scratch, "materialise", recorded)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, links = jaccard.join(docs)
    return kept, links.count()


def leaders(kept):
    return sum(t.count() for t in kept if "central" in t.columns)


def near(copies):
    """Texts of one group that differ in one word at the end."""
    return [" ".join([*(f"w{i}" for i in range(80)), f"end{c}"]) for c in range(copies)]


def test_short_lists_have_no_leaders(spark, monkeypatch):
    kept, links = tables_of(spark, monkeypatch, near(4))
    assert links == 6
    assert leaders(kept) == 0


def test_entries_are_kept_with_the_sizes_of_their_lists(spark, monkeypatch):
    kept, links = tables_of(spark, monkeypatch, near(jaccard.SHORT_LIST + 4))
    assert links >= jaccard.SHORT_LIST + 3
    assert leaders(kept) > 0
    listed = [t for t in kept if {"cls", "pos", "size"} <= set(t.columns)]
    assert len(listed) == 1
    assert listed[0].groupBy("key", "size").count().where("count != size OR size < 2").count() == 0
