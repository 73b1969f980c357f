"""The whole way from raw snapshots to comparison tables on the small tables."""

import pytest
from pyspark.sql import functions as F

from quotelift.operators import training
from quotelift.plans import flows
from quotelift.session import materialize
from quotelift.sources.standins import view

KEY = "CD_NUMERO_COTACAO"


@pytest.fixture(scope="module")
def segmented(spark):
    folder = "/root/testdata/sf0.01"
    quotes, _ = flows.clean_quotes(view(spark, folder, "v_bronze"), tie="SEQ")
    summary, _ = flows.clean_summary(view(spark, folder, "v_summary"))
    detail, _ = flows.clean_detail(view(spark, folder, "v_detail"))
    out, log = flows.join_and_segment(quotes, summary, detail, count_rows=True)
    saved = materialize(out, "segmented")
    assert [e.status for e in log] == ["APPLIED"] * 4
    assert log[-1].rows_after == saved.count() > 200
    return saved


@pytest.fixture(scope="module")
def data(segmented):
    wanted = dict.fromkeys(
        ["VL_PREMIO_ALVO", "DS_PRODUTO_NOME", "DIAS_VALIDADE", "DIAS_COTACAO", "DIAS_INICIO_VIGENCIA"], True
    )
    return flows.training_data(segmented, wanted, months=("2023-13",))


def test_segmented_columns(segmented):
    assert {"SEG", "label", "MES", "VL_GWP_CORRETOR_resumo", "HR_2025_detalhe"} <= set(segmented.columns)
    assert not {"CANAL", "DS_TIPO_COTACAO", "DS_STATUS", "CD_NUM_PROPOSTA"} & set(segmented.columns)
    assert dict(segmented.dtypes)["HR_2025_detalhe"] == "decimal(17,6)"
    assert segmented.groupBy(KEY).count().filter("count > 1").count() == 0


def test_split_is_disjoint_and_complete(segmented, data):
    a, b = data.model.select(KEY), data.valid.select(KEY)
    assert a.intersect(b).count() == 0
    assert a.count() + b.count() == segmented.count()
    assert data.features.categorical == ["DS_PRODUTO_NOME"]


def test_train_score_compare(segmented, data):
    fit = flows.cluster_brokers(segmented, 2, restarts=1)
    full = flows.with_cluster(data, fit)
    combos = training.grid([2], [0.1, 0.05])
    result = flows.train(full, KEY, combos=combos, cv_iterations=2, final_iterations=2)
    assert result.cv.count() == 2
    chosen = result.evaluation.collect()
    assert {r["model_id"] for r in chosen} == {"d2_s01", "d2_s005"}
    n = full.valid.count()
    assert {r["n_eval"] for r in chosen} == {n}
    wide = materialize(flows.score(full.valid, result.models, KEY, metadata={"mode_code": "D"}), "wide")
    assert wide.count() == n
    out = flows.compare(wide, KEY, cluster="CLF_CORRETOR", train_quality=result.train_quality)
    assert set(out) == {
        "base_rate", "topk", "quality", "pr_curve", "score_histogram", "score_stats", "selection",
        "rank_correlation", "overlap", "overfit", "cluster_profile", "cluster_metrics",
        "cluster_pr_curve", "cluster_topk", "cluster_stats",
    }
    assert out["topk"].count() == 200 and out["overlap"].count() == 100
    last = out["topk"].filter("k_pct = 100").collect()
    assert all(r["tp"] + r["fp"] == n and r["lift_at_k"] == pytest.approx(1.0) for r in last)
    assert out["overlap"].filter("k_pct = 100").first()["n_overlap"] == n
    assert out["selection"].count() == 2 and out["overfit"].count() == 2
    clustered = wide.filter(F.col("CLF_CORRETOR").isNotNull()).count()
    assert out["cluster_profile"].agg(F.sum("n_rows")).first()[0] == clustered
    for name in ("cluster_metrics", "cluster_pr_curve", "cluster_topk", "cluster_stats", "score_histogram"):
        assert out[name].count() > 0


def test_typed_before_the_rules(spark, segmented):
    """Numbers kept as text are typed first; the rules then give the same table."""
    bronze = view(spark, "/root/testdata/sf0.01", "v_bronze")
    text = bronze.select(*[F.col(c).cast("string").alias(c) if c == "VL_PREMIO_ALVO" else c for c in bronze.columns])
    typed = flows.typed_bronze(text, codes=[KEY])
    kinds = dict(typed.dtypes)
    assert kinds[KEY] == "string" and set(kinds.values()) & {"bigint", "double"}
    pinned = flows.typed_bronze(text, codes=[KEY], types={"VL_PREMIO_ALVO": "bigint", KEY: "bigint"})
    assert dict(pinned.dtypes)["VL_PREMIO_ALVO"] == "bigint" and dict(pinned.dtypes)[KEY] == "string"
    columns = [KEY, "SEQ", "CANAL", "DS_TIPO_COTACAO", "DS_GRUPO_STATUS", "label", "MES", "DIAS_COTACAO", "VL_PREMIO_ALVO"]
    plain, _ = flows.clean_quotes(bronze, tie="SEQ")
    first, _ = flows.clean_quotes(bronze, tie="SEQ", infer=True, codes=[KEY])
    as_text = lambda df: df.select([F.col(c).cast("string").alias(c) for c in columns])
    assert as_text(plain).exceptAll(as_text(first)).count() == 0 and plain.count() == first.count()


def test_features_are_selected_inside_a_run(data):
    light = {"methods": {"rf": {"numTrees": 3, "maxDepth": 3}, "lr_l1": {"maxIter": 5}}, "seeds": [1]}
    every = set(data.features.categorical + data.features.numeric)
    best = flows.select_features(data, KEY, top=2, pinned=["DS_PRODUTO_NOME"], **light)
    order = [r["feature"] for r in best.ranked.orderBy("rank_final").collect()]
    assert set(order) == every
    assert set(best.categorical + best.numeric) == {*order[:2], "DS_PRODUTO_NOME"}
    assert best.quality.count() == 2
    given = flows.select_features(data, KEY, explicit=["DIAS_COTACAO"], **light)
    assert (given.categorical, given.numeric) == ([], ["DIAS_COTACAO"])
    for wrong in ({"pinned": ["NOPE"]}, {"explicit": []}, {"explicit": ["NOPE"]}):
        with pytest.raises(ValueError):
            flows.select_features(data, KEY, **wrong, **light)
    combos = training.grid([2], [0.1])
    result = flows.train(data, KEY, combos=combos, cv_iterations=2, final_iterations=2, select={"top": 1, **light})
    assert result.models.categorical + result.models.numeric == order[:1]
    assert result.selected.ranked.count() == len(every)
    with pytest.raises(ValueError, match="either selected or given"):
        flows.train(data, KEY, numeric=["DIAS_COTACAO"], select={"top": 1})


def test_empty_segment_is_an_error(data):
    models = training.ScoringSet([], [], {}, {})
    with pytest.raises(ValueError, match="no rows"):
        flows.score(data.valid, models, KEY, segment="NONE")
