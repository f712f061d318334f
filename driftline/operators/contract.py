"""Model contract test: expected input schema, run sample rows, check the output type."""

from __future__ import annotations

from pyspark.sql import DataFrame


def check_model_contract(model, sample: DataFrame, expected_inputs: dict[str, str], output_col: str,
                         output_type: str, n: int = 5) -> dict:
    """Compare the sample's schema with ``expected_inputs`` (sorted lists, not ``list.sort()``
    return values), score ``n`` rows and check the output column's type."""
    actual = {f.name: f.dataType.simpleString() for f in sample.schema.fields}
    missing = sorted(set(expected_inputs) - set(actual))
    wrong = sorted(c for c, t in expected_inputs.items() if c in actual and actual[c] != t)
    out_ok = False
    if not missing:
        scored = model.transform(sample.limit(n))
        out_ok = output_col in scored.columns and scored.schema[output_col].dataType.simpleString() == output_type
        out_ok = out_ok and len(scored.take(n)) > 0
    return {"passed": not missing and not wrong and out_ok, "missing": missing, "wrong_type": wrong,
            "output_ok": out_ok}
