"""Writing results: JSON lines, appends, and the choice of what to keep."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from dielens.plans.hold import Kept

OUTPUT_MODES = ("csv", "dataframe", "df_4_debug")

# The result files of a job.
SIGNATURE_FILE = "cluster_signature.json"
ASSOCIATION_FILE = "cluster_wafer_association.json"
PARETO_FILE = "cluster_register_pareto.json"
SAMPLE_FILE = "scatter_sample_{model}.json"


def write_json(df: DataFrame, path: str) -> None:
    """Lower-cased names, one JSON object per line, written by the tasks in parallel."""
    df.toDF(*[c.lower() for c in df.columns]).write.mode("overwrite").json(path)


def append_rows(df: DataFrame, target: str, jdbc: dict | None = None) -> None:
    """Appends to a JDBC table (``jdbc`` = its url and properties) or a catalog table."""
    if jdbc is not None:
        df.write.jdbc(jdbc["url"], target, mode="append", properties=jdbc.get("properties", {}))
    else:
        df.write.mode("append").saveAsTable(target)


def output_modes(requested: str | Sequence[str], output_dir: str | None = None) -> set[str]:
    """The requested outputs; an error for an unknown one or for files without a folder."""
    modes = {requested} if isinstance(requested, str) else set(requested)
    unknown = modes - set(OUTPUT_MODES)
    if unknown or not modes:
        raise ValueError(f"unknown output mode {sorted(unknown)}, choose from {OUTPUT_MODES}")
    if "csv" in modes and output_dir is None:
        raise ValueError("file output needs an output folder")
    return modes


@dataclass(frozen=True)
class Result:
    """What one analysis produced; every frame is lazy."""

    dies: DataFrame
    stacked_map: DataFrame
    cluster_pareto: DataFrame
    signature: DataFrame
    wafer_association: DataFrame
    pareto_lists: DataFrame
    scatter_samples: dict[str, DataFrame]  # per model, the rows behind its pair plot
    raw: DataFrame
    models: tuple[str, ...]
    failure_modes: tuple[str, ...]
    skipped_modes: dict[str, str]
    held: Kept = field(default_factory=Kept)

    def release(self) -> None:
        """Gives back what the analysis held; no frame can be read after that."""
        self.held.release()

    def save(self, job_id: str, requested: str | Sequence[str], output_dir: str | None = None) -> dict:
        """Writes the files and returns paths and frames of the requested outputs."""
        modes = output_modes(requested, output_dir)
        out: dict = {}
        if "csv" in modes:
            files = {
                "cluster_signature_json": (self.signature, SIGNATURE_FILE),
                "wafer_association_json": (self.wafer_association, ASSOCIATION_FILE),
                "cluster_pareto_json": (self.pareto_lists, PARETO_FILE),
            }
            for model, sample in self.scatter_samples.items():
                files[f"scatter_sample_{model}_json"] = sample, SAMPLE_FILE.format(model=model)
            for key, (frame, name) in files.items():
                out[key] = f"{job_id}_{name}"
                write_json(frame, f"{output_dir}/{out[key]}")
        if "dataframe" in modes:
            out["dataframe"] = self.dies
        if "df_4_debug" in modes:
            out["raw_data"] = self.raw
        return out
