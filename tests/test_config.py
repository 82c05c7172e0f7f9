import pytest

from batchgauge.config import (
    METRIC_NAMES, DriftSpec, EvalSpec, metric_findings, project_from_mapping,
)

RAW = {
    "project_id": "fraud",
    "status": "active",
    "owner": "team",
    "model": {"mlflow_name": "fraud"},
    "input": {"source": "file", "connection": {"path": "x_{run_date}.csv"}},
    "schema": {"id_columns": ["txn_id"], "feature_columns": ["amount"], "output_columns": ["p"]},
    "output": {"target_table": "results.fraud", "dedup_key": "txn_id"},
    "schedule": {"cron": "0 8 * * *"},
    "evaluation": {"metrics": ["auc_roc"], "thresholds": {"auc_roc": 0.8}},
    "monitoring": {"row_count_change_max_pct": 30, "prediction_range": {"p": [0.0, 1.0]},
                   "drift": {"enabled": True, "reference": "last_7_days"}},
}


def test_sections_become_dataclasses_with_defaults():
    p = project_from_mapping(RAW)
    assert p.model.version == "Production"
    assert p.schema.id_columns == ("txn_id",)
    assert p.output.write_mode == "append" and p.output.dedup_key == ("txn_id",)
    assert p.monitoring.prediction_range == {"p": (0.0, 1.0)}
    assert p.monitoring.null_output_max_pct == 0.0
    assert p.monitoring.drift == DriftSpec(True, 0.10, 0.25, "last_7_days")
    assert p.monitoring.drift.reference_days == 7


@pytest.mark.parametrize("section, key", [
    ("model", "mlflow_name"), ("output", "target_table"), ("schema", "feature_columns"),
])
def test_required_fields(section, key):
    raw = {**RAW, section: {k: v for k, v in RAW[section].items() if k != key}}
    with pytest.raises(ValueError, match=f"{section}.{key}"):
        project_from_mapping(raw)


def test_project_id_required():
    with pytest.raises(ValueError, match="project_id"):
        project_from_mapping({k: v for k, v in RAW.items() if k != "project_id"})


def test_unknown_metric_is_rejected():
    with pytest.raises(ValueError, match="no metric is called 'nonexistent'"):
        EvalSpec(metrics=("auc_roc", "nonexistent"))
    assert EvalSpec(metrics=()).metrics == ()


def test_thirteen_metrics():
    assert len(METRIC_NAMES) == 13


def test_metric_findings():
    assert metric_findings(["mse"], {"mse": 1.0}) == [("mse", True, "")]
    found = {name: usable for name, usable, _ in metric_findings(["mse", "nope"], {"r2": 0.5})}
    assert found == {"mse": True, "nope": False, "r2": False}


def test_bad_drift_window():
    with pytest.raises(ValueError, match="last_30_days"):
        DriftSpec(reference="yesterday").reference_days
