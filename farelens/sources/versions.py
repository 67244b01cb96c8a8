"""Tables that are replaced as a whole: write a new version aside, then switch.

A version is a folder of its own under the table's root.  It counts once its
number is committed: the commit is a file that only one writer can create, so
of two writers that read the same version one wins and the other has to look
again.  The catalog table is then pointed at the new folder with ``ALTER
TABLE SET LOCATION``.  Readers see the old rows or the new ones, never a gap,
and a load that fails leaves the table as it was.

The table is declared without partition columns over folders that may have
some; Spark finds them on reading, and filters on them prune as usual.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> dict[int, str]:
    """Committed version numbers and their folders."""
    out = {}
    for name in _names(spark, f"{root}/{COMMITS}"):
        if name.isdigit():
            p, fs = _path(spark, f"{root}/{COMMITS}/{name}")
            stream = fs.open(p)
            try:
                out[int(name)] = f"{root}/{stream.readUTF()}"
            finally:
                stream.close()
    return out


def current(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """(number, folder) of the newest committed version; (0, None) if there is none."""
    found = versions(spark, root)
    last = max(found, default=0)
    return last, found.get(last)


def read_version(spark: SparkSession, root: str) -> DataFrame | None:
    _, folder = current(spark, root)
    return spark.read.parquet(folder) if folder else None


def commit(spark: SparkSession, root: str, number: int, folder: str) -> None:
    """Make ``folder`` version ``number``; CommitConflict if the number is taken."""
    p, fs = _path(spark, f"{root}/{COMMITS}/{number}")
    if fs.exists(p):
        raise CommitConflict(f"version {number} of {root} exists")
    # The name is written before the file gets its number; a rename does not replace an existing file.
    part, _ = _path(spark, f"{root}/{COMMITS}/.{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    stream.writeUTF(folder)
    stream.close()
    if not _claim(spark, fs, part, p):
        fs.delete(part, False)
        raise CommitConflict(f"version {number} of {root} exists")


def _claim(spark: SparkSession, fs, part, p) -> bool:
    """Rename without replacing: False if ``p`` exists (decided by the store, as in HDFS)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(part), fs.makeQualified(p), options)
        return True
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            return False
        raise


def _write(df: DataFrame, path: str, partition_by: list[str] | None) -> None:
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)


def write_version(df: DataFrame, root: str, after: int, partition_by: list[str] | None = None) -> int:
    """Write ``df`` aside and commit it as the version after ``after``; returns its number."""
    folder = f"v-{uuid.uuid4().hex}"
    _write(df, f"{root}/{folder}", partition_by)
    commit(df.sparkSession, root, after + 1, folder)
    return after + 1


def switch(spark: SparkSession, table: str, root: str) -> None:
    """Point ``table`` at the newest version, declaring it if need be.

    Two writers may switch in the other order than they committed; each looks
    again behind its switch, so the last one leaves the newest version.
    """
    while True:
        number, folder = current(spark, root)
        if folder is None:
            raise ValueError(f"no version of {root}")
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        if current(spark, root)[0] == number:
            return


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0].data_type


def root_of(spark: SparkSession, table: str) -> str:
    """The folder of a table's versions: beside the one it was first stored in."""
    now = location(spark, table).rstrip("/")
    above, _, last = now.rpartition("/")
    return above if last.startswith("v-") else f"{now}_versions"


def adopt(spark: SparkSession, table: str, root: str) -> None:
    """Make an existing plain table's rows the first version."""
    if current(spark, root)[1] is None and spark.catalog.tableExists(table):
        try:
            write_version(spark.table(table), root, 0)
        except CommitConflict:
            pass


def publish(df: DataFrame, table: str, root: str, partition_by: list[str] | None = None) -> int:
    """Replace all rows of ``table``; its readers see the old rows until the new ones are all there.

    Returns the version's number.  A reload does not depend on the rows
    before it, so after another writer's commit it just takes the next number.
    """
    spark = df.sparkSession
    folder = f"v-{uuid.uuid4().hex}"
    _write(df, f"{root}/{folder}", partition_by)
    while True:
        number = current(spark, root)[0] + 1
        try:
            commit(spark, root, number, folder)
            break
        except CommitConflict:
            continue
    switch(spark, table, root)
    return number


def update(spark: SparkSession, table: str, root: str, change: Callable[[DataFrame | None], DataFrame | None],
           tries: int = 20) -> int:
    """Replace the rows of ``table`` by ``change`` of them, however many writers do so at once.

    ``change`` gets the newest version (None: there is none) and returns the
    new rows, or None for no change.  If another writer commits in between,
    it is called again with that one's rows.  Returns the version's number.
    """
    for _ in range(tries):
        number, folder = current(spark, root)
        new = change(spark.read.parquet(folder) if folder else None)
        if new is None:
            switch(spark, table, root)
            return number
        try:
            number = write_version(new, root, number)
        except CommitConflict:
            continue
        switch(spark, table, root)
        return number
    raise CommitConflict(f"{table}: {tries} other commits in a row")


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the newest ``keep`` versions; queries that still read them end with an error.

    Their numbers stay committed, so no number is given twice.
    """
    found = versions(spark, root)
    gone = []
    for number in sorted(found)[:-keep]:
        p, fs = _path(spark, found[number])
        if fs.exists(p) and fs.delete(p, True):
            gone.append(found[number])
    return gone
