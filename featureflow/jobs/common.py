from __future__ import annotations

import argparse

from featureflow import presets
from featureflow.session import get_session

PRESETS = {"flights": presets.FLIGHTS, "tpch": presets.TPCH}


def base_parser(description: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    p.add_argument("--preset", choices=sorted(PRESETS), default="flights")
    p.add_argument("--master", default=None, help="only for local runs; clusters pass it to spark-submit")
    return p


def session(args, app: str):
    return get_session(app=app, master=args.master)


def report(metrics, path: str | None) -> None:
    """Show a metrics table; written as Parquet first when a folder is given."""
    if path:
        metrics.write.mode("overwrite").parquet(path)
        metrics = metrics.sparkSession.read.parquet(path)
    metrics.show(truncate=False)


def raw_types(spec) -> dict:
    """Types of the raw columns that are not cast by the static stage: calendar columns and the filtered flag."""
    types = {name: "int" for c in spec.cyclic for name in (c.name, c.month_col) if name}
    if spec.exclude is not None and isinstance(spec.exclude[1], int):
        types[spec.exclude[0]] = "int"
    return types


def load_table(spark, path: str, work_dir: str | None, name: str, spec, most_rejects: float | None = None):
    """CSV is kept as Parquet under ``work_dir``, where only files that are new or changed are read
    (``most_rejects``: malformed records are kept apart, up to that share); Parquet is read as is."""
    from featureflow.sources import ingest, io
    if path.endswith(".parquet"):
        return io.read_parquet(spark, path)
    if work_dir:
        # files that no longer match are dropped; when none matches any more, the copy is all there is
        some = not ingest.list_files(spark, path).isEmpty()
        return ingest.ingest_files(spark, path, f"{work_dir}/{name}", types=raw_types(spec), prune=some,
                                   quarantine=most_rejects is not None, most_rejects=most_rejects)
    return io.read_csv(spark, path, types=raw_types(spec))
