import corpus_pipeline
from marlstone.llm.packing import CAPACITY
from marlstone.session import shared_dir
from tests.llm.helpers import SCHEMA, near_roots, table
from tests.llm.test_exact import plain
from tests.llm.test_paragraphs import words

EXTRA = "verdict string, near string, copies string, label int"


def documents():
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words(f"doc{i}", 90)), "en", f"src{i % 2}", 1))
    passage = " ".join(words("shared", 70))
    for i in (5, 15, 25):
        rows[i] = (i, f"{rows[i][1]} {passage} {' '.join(words(f'more{i}', 40))}", *rows[i][2:])
    for i in (7, 8):
        rows.append((100 + i, rows[i][1].replace(" ", "\n", 3), "en", "src1", 1))
        rows.append((200 + i, rows[i][1] + " tail", "en", "src1", 1))
    rows += [(300, None, "en", "src0", 0), (301, "", None, None, None), (302, "too short", "en", "src0", 9), (303, "### " * 200 + rows[3][1], "en", "src0", 1)]
    rows += [(304, "again and again " * 40, "en", "src0", 1), (305, " ".join(words("long", 6000)), "en", "src1", 1), rows[2], rows[2]]
    return [(*r, "v", "n", "c", 1) for r in rows]


def test_stages_equal_brute_force(spark):
    df = table(spark, documents(), f"{SCHEMA}, {EXTRA}")
    folder = shared_dir(spark, "test-pipeline")
    df.write.parquet(f"{folder}/documents.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == df.columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
        assert docs.count() == len(seen[-1]) or stage is corpus_pipeline.quality_rules
    bad = {300, 301, 302, 303, 304}
    good = [(i, t) for i, t, *_ in documents() if i not in bad]
    assert set(seen[0]) == {i for i, _ in good}
    first = {}
    for i, t in sorted(good):
        first.setdefault(plain(t), i)
    assert set(seen[1]) == set(first.values())
    left = sorted((i, t) for i, t in good if i in seen[1])
    left = sorted(dict(left).items())
    assert set(seen[2]) == {left[r][0] for r in near_roots(left)}
    assert set(seen[3]) == set(seen[2])
    for i, t in seen[3].items():
        assert t == seen[2][i] if i not in (15, 25) else len(seen[2][i].split()) - 80 < len(t.split()) < len(seen[2][i].split()) - 40
    packed = corpus_pipeline.run(spark, folder).toPandas()
    assert set(packed.doc_id) == set(seen[3])
    assert packed.groupby("sequence_id").length.sum().max() <= CAPACITY
    assert packed.sequence_id.nunique() <= -(-packed.length.sum() // CAPACITY) + 1


def test_empty_documents(spark):
    folder = shared_dir(spark, "test-pipeline")
    table(spark, documents(), f"{SCHEMA}, {EXTRA}").limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
