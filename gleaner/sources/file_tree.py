"""Small files below one folder, listed and read by tasks.

Spark's file readers keep an entry for every file and folder on the driver, which a store of a file per page outgrows.
Here tasks list the folders round by round into a scratch table, the files are read by tasks from that table, and the
driver sees counts. The names of one folder are held by one task.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import scratch_dir
from gleaner.sources.slices import qualified

# What one task lists or reads.
FOLDERS_PER_TASK, FILES_PER_TASK, BYTES_PER_TASK = 4096, 4096, 64 * 1024 * 1024
# A task goes on into the folders it finds while it has fewer than this, so that small trees need one round.
FOLDERS_AHEAD = 64
# Names, and bytes of files, that leave a task together.
MAX_NAMES, MAX_BATCH = 8192, 16 * 1024 * 1024

_ENTRY = "path string, size long, is_folder boolean"
_PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-!.~'()*,;:$&+=/@")


class Listing(NamedTuple):
    uri: str  # the root as pyarrow opens it
    shown: str  # and as Spark writes it
    files: DataFrame  # path below the root, with a slash in front, and size
    count: int
    size: int


def _opens(uri: str) -> bool:
    from pyarrow import fs as pafs

    try:
        fs, base = pafs.FileSystem.from_uri(uri)
        return fs.get_file_info(base).type == pafs.FileType.Directory
    except (pa.ArrowException, OSError):
        return False


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _seen(name: str, is_folder: bool) -> bool:
    """Whether Spark's readers look at a name."""
    return not _hidden(name) or is_folder and name.startswith(("_metadata", "_common_metadata"))


def _tasks(spark: SparkSession, count: int, *needed: int) -> int:
    return max(1, min(count, spark.sparkContext.defaultParallelism), *needed)


def list_files(spark: SparkSession, root: str, ending: str) -> Listing | None:
    """All files below a root whose names have an ending, by the rules of Spark's readers: hidden names and empty files are
    left out. None where the root is no folder, or none that pyarrow can open."""
    uri, shown = qualified(spark, root)
    if not _opens(uri):
        return None

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(uri)
        base, listed, rows = base.rstrip("/"), 0, []

        def emit():
            columns = zip(*rows) if rows else [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()))],
                names=["path", "size", "is_folder"])

        for batch in batches:
            todo = deque(batch.column("path").to_pylist())
            while todo:
                folder, listed = todo.popleft(), listed + 1
                for x in fs.get_file_info(pafs.FileSelector(f"{base}{folder}" or "/")):
                    path, name, is_folder = f"{folder}/{x.base_name}", x.base_name, x.type == pafs.FileType.Directory
                    if is_folder and _seen(name, True) and listed + len(todo) < FOLDERS_AHEAD:
                        todo.append(path)
                    elif is_folder and _seen(name, True):
                        rows.append((path, 0, True))
                    elif x.type == pafs.FileType.File and x.size and name.endswith(ending) and _seen(name, False):
                        rows.append((path, x.size, False))
                    if len(rows) == MAX_NAMES:
                        yield emit()
                        rows = []
        yield emit()

    where, rounds = scratch_dir(spark, "files"), []
    folders, count = spark.range(0, 1, 1, 1).select(F.lit("").alias("path")), 1
    while count:
        rounds.append(f"{where}/round{len(rounds)}")
        dealt = folders.repartition(_tasks(spark, count, -(-count // FOLDERS_PER_TASK)))
        dealt.mapInArrow(entries, _ENTRY).write.parquet(rounds[-1])
        folders = spark.read.schema(_ENTRY).parquet(rounds[-1]).where("is_folder").select("path")
        count = folders.count()
    files = spark.read.schema(_ENTRY).parquet(*rounds).where("NOT is_folder").select("path", "size")
    return Listing(uri, shown.rstrip("/"), files, *files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first())


def uri_path(path: str) -> str:
    """A path as ``_metadata.file_path`` spells it: what may not stand in a URI is escaped, other letters are kept."""
    return "".join(c if c in _PLAIN or c > "\x9f" and not c.isspace() else quote(c) for c in path)


def read_files(listing: Listing, cell: Callable[[bytes], bytes | str], kind: str = "binary", spell: Callable[[str], str] = str) -> DataFrame:
    """(path, content) of listed files; ``cell`` makes the content, of type ``kind``, of the bytes of a file, ``spell`` its
    path of the one that Spark writes. Files leave a task in batches of about ``MAX_BATCH`` bytes.
    """
    uri, shown, files, count, size = listing

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(uri)
        base = base.rstrip("/")
        paths, cells, held = [], [], 0

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(cells, pa.string() if kind == "string" else pa.binary())],
                names=["path", "content"])

        for batch in batches:
            for path, n in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()):
                if cells and (held + n > MAX_BATCH or len(cells) == MAX_NAMES):
                    yield emit()
                    paths, cells, held = [], [], 0
                with fs.open_input_stream(f"{base}{path}", compression=None) as file:
                    cells.append(cell(file.read()))
                paths.append(spell(f"{shown}{path}"))
                held += n
        if cells:
            yield emit()

    dealt = files.repartition(_tasks(files.sparkSession, count, -(-count // FILES_PER_TASK), -(-size // BYTES_PER_TASK)))
    return dealt.mapInArrow(read, f"path string, content {kind}")


def not_broadcast(df: DataFrame, listing: Listing) -> DataFrame:
    """What was read of files, which a join broadcasts by their size only: the plan knows no more than that of their names."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df.hint("merge") if listing.size > limit else df
