import corpus_pipeline
import public_tokenizers
import pytest
from helpers import documents, linked_components, lower_ascii
from test_packing import check

from usagelens.llm import pii, quality
from usagelens.llm.common import WORD_BPE
from usagelens.storage import materialize


def test_each_stage_against_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "near duplicates", "personal data", "packing",
    ]
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, made[-1], sf)
        assert name == "packing" or out.schema == docs.schema
        made.append(materialize(out, "stage"))
    rows = [{r.doc_id: r for r in df.collect()} for df in made[:-1]]

    weights = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = quality.score_quality(docs, weights).collect()
    assert rows[1].keys() == {r.doc_id for r in scored if r.score >= 0.5}

    first = {}
    for i in sorted(rows[1]):
        first.setdefault(lower_ascii(rows[1][i].text), i)
    assert rows[2].keys() == set(first.values())

    found = linked_components([(i, r.text) for i, r in rows[2].items()], 5, 80)
    assert rows[3].keys() == {i for i, _, root in found if i == root}

    known = pii.replacer(corpus_pipeline.DEMO_KEY)
    assert {i: r.text for i, r in rows[4].items()} == {i: known.replace(r.text)[0] for i, r in rows[3].items()}

    kept = [(i, r.text) for i, r in rows[4].items()]
    check(made[-1].collect(), kept, 2048, public_tokenizers.path(WORD_BPE))
    # Which documents meet in a sequence follows the order of rows in files, the pieces do not.
    check(corpus_pipeline.run(spark, sf).collect(), kept, 2048, public_tokenizers.path(WORD_BPE))


def odd_documents(spark):
    """NULL, empty and repeated rows, texts and ids, and columns whose names could clash."""
    prose = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (2, ""), (3, " \n"), (4, prose), (4, prose), (5, prose.upper()), (6, prose + " more"), (6, "other text"),
        (None, prose), (None, None), (7, "mail a.b@c.org " * 3000), (8, "card 4041894974608795"), (8, "card 4041894974608795"),
    ]
    odd = documents(spark, rows)
    return odd.selectExpr("*", "'a' as hash_of_row", "'b' as kept", "3 as lost_doc_id", "'c' as again", "4 as component_id")


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, sf, empty):
    docs = odd_documents(spark)
    docs = materialize(docs.limit(0) if empty else docs, "odd")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.schema == docs.schema
        seen[name] = out.collect()
        assert not empty or not seen[name]
    if empty:
        return
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(lower_ascii(t), (i, t))
    ids = sorted((r.doc_id for r in seen["exact dedup"]), key=repr)
    assert ids == sorted((i for i, _ in first.values()), key=repr)
    near = linked_components(rows, 5, 80)
    kept = {i for i, _, root in near if i == root}
    assert sorted((r.doc_id for r in seen["near duplicates"]), key=repr) == sorted((i for i, _ in rows if i in kept), key=repr)
    assert [r.text is None for r in sorted(seen["personal data"], key=repr)].count(True) == 2
    assert len(seen["personal data"]) == len(rows)
