"""The pipeline against a straightforward version of its decisions."""

import sys

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decisions_take_effect(spark):
    import corpus_pipeline as cp
    from tidemark.llm import decontam, groupjoin, rules
    from tidemark.llm.common import prepare, store, table
    from tidemark.llm.queries import quality_model

    prepare(spark)
    docs = table(spark, SF, "documents")
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixture", "token_ids"]
    out = {}
    for name, stage in cp.STAGES:
        last, docs = docs, store(stage(spark, docs, SF), name)
        out[name] = docs
        if name != "token_ids":
            assert docs.columns == last.columns
    rejected = rules.score(table(spark, SF, "documents"), quality_model(spark, SF)).where("score < 0.5")
    assert out["quality"].count() == table(spark, SF, "documents").count() - rejected.count()
    near = groupjoin.join_components(out["near_duplicates"])
    assert near.where("n_shingles > 0").count() == near.where("n_shingles > 0").select("component_id").distinct().count()
    assert decontam.contaminated(out["decontamination"], table(spark, SF, "benchmark")).count() == 0
    words = lambda df: df.selectExpr(r"sum(regexp_count(text, '[^\\x20\\x09-\\x0D]+'))").first()[0]
    assert abs(words(out["mixture"]) / words(out["decontamination"]) - 1.5) < 0.1
    assert out["token_ids"].count() == out["mixture"].count()


def test_entry_registers_pipeline_and_queries():
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_workers_give_memory_back_after_the_last_row(monkeypatch):
    from tidemark.llm import common

    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append("back"))

    @common.lean
    def double(batches):
        for x in batches:
            told.append(x)
            yield 2 * x

    assert list(double(iter([1, 2]))) == [2, 4] and told == [1, 2, "back"]
    left = double(iter([3, 4]))
    assert next(left) == 6
    left.close()  # a task that is ended early gives back too
    assert told[-2:] == [3, "back"]
