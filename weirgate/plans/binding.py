"""From a pipeline's name to its checked functions, and the entry point of a batch run."""

from __future__ import annotations

import datetime
import importlib
import inspect
import os
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..contract import ContractError, PipelineSpec, load
from ..operators.lineage import Lineage
from . import acquisition, purity, runner

#: The package below which authors' modules are.
NAMESPACE = "pipelines"


def _function(module, name: str, needed: bool) -> Callable | None:
    found = getattr(module, name, None)
    if found is None:
        if needed:
            raise ContractError(f"{module.__name__} has no {name}")
        return None
    kinds = [p.kind for p in inspect.signature(found).parameters.values()]
    if kinds != [inspect.Parameter.POSITIONAL_OR_KEYWORD] * 2:
        raise ContractError(f"{module.__name__}.{name} takes two positional arguments")
    return found


def bind(spec: PipelineSpec) -> runner.Pipeline:
    """The author's module of a specification: ``pipelines/x`` is ``pipelines.x.transforms``.

    Its functions take two arguments and are pure plans."""
    parts = spec.name.split("/")
    if parts[0] != NAMESPACE or len(parts) < 2 or not all(p.isidentifier() for p in parts):
        raise ContractError(f"pipeline {spec.name!r} is not below {NAMESPACE}/")
    module = importlib.import_module(".".join([*parts, "transforms"]))
    if faults := purity.findings(inspect.getsource(module)):
        raise ContractError(f"{module.__name__}: " + "; ".join(f"line {n}: {what}" for n, what in faults))
    return runner.Pipeline(spec, _function(module, "apply", True), _function(module, "post_check", False), _function(module, "fold", False))


def main(spark: SparkSession, argv: list[str]) -> runner.Batch:
    """Runs a batch: --spec, --root, --batch_id, --delivery_id, --feed_id,
    --received_at (ISO) and --uris (comma-separated)."""
    given = acquisition.arguments(argv)
    if missing := sorted({"spec", "root", "batch_id", "delivery_id", "feed_id", "received_at", "uris"} - set(given)):
        raise ContractError(f"missing arguments: {', '.join(missing)}")
    uris = given["uris"].split(",")
    if "://" in uris[0] and (odd := acquisition.consistent_uris(uris, given["feed_id"], given["delivery_id"])):
        raise ContractError(f"{len(odd)} addresses are not of delivery {given['delivery_id']}")
    if not os.path.exists(given["spec"]):
        raise ContractError("no such specification")
    pipeline = bind(load(given["spec"]))
    received = datetime.datetime.fromisoformat(given["received_at"])
    return runner.run(spark, pipeline, Lineage(given["batch_id"], given["delivery_id"], given["feed_id"], received), uris, runner.Stores.at(spark, given["root"], domain_id=pipeline.spec.domain_id))
