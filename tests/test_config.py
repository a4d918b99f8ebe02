"""Fixed values and contracts (the reference's config tests, re-aimed at our constants)."""

from featurepipe.operators import dataset, metrics, model, scoring, views


def test_feature_columns_fixed_order():
    assert len(dataset.FEATURE_COLUMNS) == 12 and len(set(dataset.FEATURE_COLUMNS)) == 12
    assert all(c in views.CUSTOMER_VIEW_COLUMNS for c in dataset.FEATURE_COLUMNS)
    assert views.CUSTOMER_VIEW_COLUMNS[0] == "customer_id" and views.CUSTOMER_VIEW_COLUMNS[-1] == "feature_ts"


def test_thresholds_and_params():
    assert metrics.DEFAULT_THRESHOLDS == {"auc": 0.60, "precision": 0.03, "recall": 0.30}
    assert model.DEFAULT_PARAMS == {"max_iter": 200, "step_size": 0.1, "max_depth": 6, "pos_weight": 33.0, "seed": 42}
    assert all(isinstance(w, float) for w in scoring.SCORECARD_WEIGHTS.values())


def test_feature_view_specs():
    for fv in (views.CUSTOMER_RISK_FEATURES, views.TRANSACTION_CONTEXT_FEATURES):
        assert isinstance(fv.name, str) and fv.name.isupper()
        assert fv.version.startswith("V") and fv.address == f"{fv.name}__{fv.version}"
        assert fv.timestamp_col == "feature_ts" and fv.refresh == "1 hour" and fv.keys
