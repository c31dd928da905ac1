"""State documents of the file-based pipeline."""

import json

from tallyloom.operators import quarantine
from tallyloom.sources import documents


def test_tracker_document(spark, tmp_path):
    doc = {
        "version": 1,
        "files": {
            "raw/a.xlsx": {"filename": "a.xlsx", "source_id": "a", "hash": "h", "size_bytes": 5,
                           "status": "processed", "processed_at": "2026-06-01T15:30:00+00:00"},
            "raw/b.xlsx": {"status": "loaded", "loaded_at": "2026-06-01T15:30:00+00:00"},
        },
    }
    (tmp_path / "tracker.json").write_text(json.dumps(doc, indent=2))
    rows = {r.file_key: r for r in documents.read_tracker(spark, str(tmp_path / "tracker.json"), "catalog").collect()}
    assert (rows["raw/a.xlsx"].hash, rows["raw/a.xlsx"].processed_at.hour) == ("h", 15)
    assert rows["raw/b.xlsx"].hash is None and rows["raw/b.xlsx"].status == "loaded"
    assert documents.read_tracker(spark, str(tmp_path / "none.json"), "x").count() == 0


def test_failure_log(spark, tmp_path):
    entries = [
        ("de_1_1", "6MM.x"), ("de_1_2", "6MM.variant_0.6*122"), ("de_1_2", "9MM.all"),
        ("de_1_3", "6mm MDF::date"), ("de_1_3", "Sheet"), ("de_1_6", "glue.parse"),
    ]
    lines = [json.dumps({"script": s, "key": k, "reason": "r", "detail": "", "timestamp": "2026-06-01T15:00:00Z"}) for s, k in entries]
    (tmp_path / "failures.log").write_text("\n".join([*lines[:3], "{broken", "", *lines[3:]]) + "\n")
    got = documents.read_failure_log(spark, str(tmp_path / "failures.log"))
    assert {(r.script, r.parent_key, r.child_key) for r in got.collect()} == {
        ("de_1_1", "6MM.x", ""), ("de_1_2", "6MM", "variant_0.6*122"), ("de_1_2", "9MM", "all"),
        ("de_1_3", "6mm MDF", "date"), ("de_1_3", "Sheet", ""), ("de_1_6", "glue", "parse"),
    }
    assert {(r.script, r.k) for r in got.select("script", quarantine.key_text().alias("k")).collect()} == set(entries)


def test_audit_log(spark, tmp_path):
    line = {"script": "de_1_4", "material": "9mm MDF", "field": "reorder_threshold", "old_value": None,
            "new_value": 500, "action": "update", "timestamp": "2026-06-01T15:00:00Z"}
    (tmp_path / "audit.log").write_text(json.dumps(line) + "\n")
    row = documents.read_audit_log(spark, str(tmp_path / "audit.log")).first()
    assert (row.material, row.old_value, row.new_value, row.ts.hour) == ("9mm MDF", None, 500, 15)


def test_config_document(spark, tmp_path):
    from tallyloom.operators import checks

    (tmp_path / "t.json").write_text('{\n  "thresholds": {\n    "9mm MDF": 500\n  }\n}\n')
    entries = checks.threshold_entries(documents.read_config(spark, str(tmp_path / "t.json")))
    assert [tuple(r) for r in checks.require_valid(checks.checked_thresholds(entries)).collect()] == [("9mm MDF", 500)]
