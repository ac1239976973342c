"""Pattern rules from YAML or JSON files, as rows."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RULE_SCHEMA = (
    "rule_idx int, name string, description string, technique_id string, severity string, "
    "event_type string, conditions array<struct<field:string,operator:string,value:string>>"
)
RULE_KEYS = ("name", "description", "technique_id", "severity", "event_type")
CONDITION_KEYS = ("field", "operator", "value")
DEFAULT_RULES = Path(__file__).resolve().parent.parent / "data" / "rules.yaml"


def _text(value) -> str:
    return "" if value is None else str(value)


def load_rules(path: str | os.PathLike | None = None) -> list[tuple]:
    """Rule definitions in file order; unknown keys are dropped, absent keys are empty.

    A rule file is configuration (tens to thousands of rows), so it is read
    where the plan is built.  JSON needs no extra package; YAML needs PyYAML.
    """
    path = Path(path or os.environ.get("DUSKWATCH_RULES_PATH") or DEFAULT_RULES)
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        docs = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - depends on the installation
            raise RuntimeError("reading YAML rules needs PyYAML; use a .json rule file instead") from e
        docs = yaml.safe_load(text)
    rules = []
    for idx, doc in enumerate(docs or []):
        conditions = [
            tuple(_text(c.get(k)) for k in CONDITION_KEYS) for c in (doc.get("conditions") or [])
        ]
        rules.append((idx, *(_text(doc.get(k)) for k in RULE_KEYS), conditions))
    return rules


def rules_frame(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)
