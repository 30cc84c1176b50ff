"""Output of a run to several datasets, published at once and once.

Every record goes to the dataset that a column names, in one pass: a task keeps a file per dataset
open. Files are written below ``root/data/<dataset>`` under names that no other attempt uses; what a write gave is
noted in ``root/_runs/<run>/<part>.json`` by its commit, and a run counts once
``root/_published/<run>.json`` names its parts. Readers take the files of published runs only, so whatever a failed task, write or
job left behind is never read, and a run that is repeated under its id adds nothing again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sluice.sources.byte_ranges import filesystem, reachable

FORMAT = "sluice_run"
TARGET = "target"
# A task with more targets than this closes the file that it has used least lately; the target goes on in another one.
OPEN_FILES = 64


@dataclass
class Written(WriterCommitMessage):
    """The files of a task: dataset, name below the root, rows."""

    files: list[tuple[str, str, int]]


def _safe(name: str) -> str:
    return quote(name, safe="")


class RunWriter(DataSourceArrowWriter):
    """Writes to the dataset that the column ``target`` names, or all to one ``dataset``."""

    def __init__(self, schema: StructType, root: str, run: str, part: str, *, target: str | None = None, dataset: str = ""):
        self.schema, self.root, self.run, self.part = schema, root.rstrip("/"), run, part
        self.target, self.dataset = target, dataset

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = filesystem(self.root)
        kept = pa.schema([field for field in to_arrow_schema(self.schema) if field.name != self.target])
        files: list[tuple[str, str, int]] = []
        open_: dict[str, tuple[pq.ParquetWriter, str, int]] = {}

        def close(target: str) -> None:
            writer, name, rows = open_.pop(target)
            writer.close()
            files.append((target, name, rows))

        def add(target: str, rows: pa.RecordBatch) -> None:
            if target in open_:
                writer, name, count = open_.pop(target)
            else:
                if len(open_) >= OPEN_FILES:
                    close(next(iter(open_)))
                folder = f"data/{_safe(target)}"
                system.create_dir(f"{base}/{folder}", recursive=True)
                name, count = f"{folder}/{_safe(self.run)}-{_safe(self.part)}-{uuid.uuid4().hex}.parquet", 0
                writer = pq.ParquetWriter(f"{base}/{name}", kept, filesystem=system)
            writer.write_batch(rows)
            open_[target] = writer, name, count + rows.num_rows

        try:
            for batch in iterator:
                rest = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in kept], schema=kept)
                if self.target is None:
                    add(self.dataset, rest)
                    continue
                targets = batch.column(self.target).dictionary_encode()
                for code, target in enumerate(targets.dictionary.to_pylist()):
                    add(target, rest.filter(pc.equal(targets.indices, code)))
                if targets.null_count:
                    raise ValueError("a record has no target")
            for target in list(open_):
                close(target)
        except BaseException:
            for target in list(open_):
                close(target)
            self._remove([Written(files)])
            raise
        return Written(files)

    def _remove(self, messages: list[Written | None]) -> None:
        system, base = filesystem(self.root)
        for message in messages:
            for _, name, _ in message.files if message else ():
                try:
                    system.delete_file(f"{base}/{name}")
                except FileNotFoundError:
                    pass

    def commit(self, messages: list[Written | None]) -> None:
        files = [file for message in messages if message for file in message.files]
        put(f"{self.root}/_runs/{_safe(self.run)}/{_safe(self.part)}.json", files)

    def abort(self, messages: list[Written | None]) -> None:
        self._remove(messages)


class RunSink(DataSource):
    """``df.write.format("sluice_run")`` with the options ``root``, ``run``, ``part``, and ``target`` or ``dataset``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        places = {name: self.options[name] for name in ("target", "dataset") if name in self.options}
        return RunWriter(schema, self.options["root"], self.options["run"], self.options["part"], **places)


# Small files that say what counts


def put(path: str, content: object) -> None:
    """Writes a small file whole or not at all: under another name first, which is then changed."""
    system, where = filesystem(path)
    folder, _, name = where.rpartition("/")
    system.create_dir(folder, recursive=True)
    new = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(new) as out:
        out.write(json.dumps(content).encode())
    system.move(new, where)


def get(path: str) -> object | None:
    system, where = filesystem(path)
    try:
        with system.open_input_stream(where) as source:
            return json.loads(source.read())
    except FileNotFoundError:
        return None


def published(root: str) -> list[str]:
    """The ids of the runs that count."""
    system, where = filesystem(f"{root.rstrip('/')}/_published")
    found = system.get_file_info(pafs.FileSelector(where, allow_not_found=True))
    names = [file.base_name for file in found if not file.base_name.startswith(".")]
    return [get(f"{root.rstrip('/')}/_published/{name}")["run"] for name in sorted(names)]


def write_run(
    root: str,
    run: str,
    *,
    whole: dict[str, DataFrame] | None = None,
    routed: list[DataFrame] | None = None,
    target: str = TARGET,
    inputs: list[str] | None = None,
) -> bool:
    """Writes the parts of a run and publishes them together; whether it did, or the run had been published before.

    The frames of ``whole`` go to the datasets of their names, the records of ``routed`` ones to those that their
    column ``target`` names. Parts of a run that failed before are written anew. ``inputs`` are names that are
    noted with the run, see :func:`inputs_of`.
    """
    root = root.rstrip("/")
    if not reachable(root):
        raise ValueError(f"tasks cannot write to {root} themselves")
    if get(f"{root}/_published/{_safe(run)}.json") is not None:
        return False
    parts = {f"whole-{name}": (df, {"dataset": name}) for name, df in (whole or {}).items()}
    parts |= {f"routed-{place}": (df, {"target": target}) for place, df in enumerate(routed or [])}
    for part, (df, places) in parts.items():
        df.sparkSession.dataSource.register(RunSink)
        before = get(f"{root}/_runs/{_safe(run)}/{_safe(part)}.json")
        sink = df.write.format(FORMAT).mode("append").options(root=root, run=run, part=part, **places)
        sink.save()
        if before:
            RunWriter(df.schema, root, run, part)._remove([Written([tuple(file) for file in before])])
    if inputs is not None:
        put(f"{root}/_runs/{_safe(run)}/_inputs.json", inputs)
    put(f"{root}/_published/{_safe(run)}.json", {"run": run, "parts": list(parts)})
    return True


def inputs_of(root: str, run: str) -> list[str]:
    """The names that were noted with a published run."""
    return get(f"{root.rstrip('/')}/_runs/{_safe(run)}/_inputs.json") or []


def read_run(spark: SparkSession, root: str, dataset: str, schema: StructType | str | None = None) -> DataFrame:
    """A dataset's records of all published runs. ``schema`` is needed where there may be none."""
    root = root.rstrip("/")
    names = []
    for run in published(root):
        for part in get(f"{root}/_published/{_safe(run)}.json")["parts"]:
            files = get(f"{root}/_runs/{_safe(run)}/{_safe(part)}.json") or []
            names += [f"{root}/{name}" for target, name, _ in files if target == dataset]
    reader = spark.read.schema(schema) if schema else spark.read
    if not names:
        if schema is None:
            raise ValueError(f"no run has written to {dataset}")
        return spark.createDataFrame([], schema)
    return reader.parquet(*names)
