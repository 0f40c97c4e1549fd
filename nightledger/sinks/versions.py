"""Results by date, replaced in one step: a reader sees all of the old or all of the new.

    path/data/version=<id>/<by>=<date>/part-...    rows of one write, not to be seen before a commit
    path/_commits/<number>.json                    which versions make up each date

A write goes to a version folder of its own. Then a commit says which folders count, by
moving one small file to the next number. What was replaced stays for the readers of
older commits and is deleted by later ones. The driver handles names of dates and
versions only, never rows.
"""

import json
import time
import uuid
from datetime import date

from pyspark.sql.types import StructType


from .files import NULL_FOLDER, write_by_date
from .tables import PARTITIONS_AT_ONCE

#: Versions that no commit names are taken for those of failed writes after this time.
ORPHAN_SECONDS = 7 * 24 * 3600
COMMIT_TRIES = 20


class DatedVersions:
    """The versions under `path`, by the date column `by`.

    `keep` older commits stay readable after a new one. Two writers may commit at the
    same time: the second finds the number taken and builds on the other's commit.
    """

    def __init__(self, spark, path, by="as_of_date", keep=1):
        self.spark, self.path, self.by, self.keep = spark, path.rstrip("/"), by, keep
        self._jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        top = self._path()
        self._files = top.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)

    def _path(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    # --- commits ---------------------------------------------------------------

    def numbers(self):
        """The commits there are, oldest first."""
        folder = self._path("_commits")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit() and name.endswith(".json"))

    def commit(self, number=None):
        """A commit, by default the newest: number, folders (versions by ISO date or ""), loads and the rows' schema."""
        number = (self.numbers() or [0])[-1] if number is None else number
        if not number:
            return {"number": 0, "folders": {}, "loads": {}, "schema": None}
        stream = self._files.open(self._path("_commits", f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, found):
        """Writes a commit under its number; False if there is one already."""
        hidden = self._path("_commits", f".{uuid.uuid4().hex}")
        out = self._files.create(hidden, False)
        out.write(bytearray(json.dumps(found).encode()))
        out.close()
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            never_over = self.spark.sparkContext._gateway.new_array(kind, 0)
            self._context.rename(hidden, self._path("_commits", f"{found['number']:012d}.json"), never_over)
            return True
        except Exception as error:
            self._files.delete(hidden, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def _commit(self, change, schema):
        for _ in range(COMMIT_TRIES):
            found = self.commit()
            change(found)
            found["number"] += 1
            found["schema"] = schema.json()
            if self._put(found):
                self.clean()
                return found
        raise RuntimeError(f"{COMMIT_TRIES} other commits came first at {self.path}")

    # --- writing ---------------------------------------------------------------

    def _written(self, df, tasks, watch):
        """Writes a version and returns its name and its dates, as found by one listing."""
        version = uuid.uuid4().hex
        folder = f"{self.path}/data/version={version}"
        write_by_date(df, folder, self.by, tasks=tasks, watch=watch)
        top = self._path("data", f"version={version}")
        names = [status.getPath().getName() for status in self._files.listStatus(top)] if self._files.exists(top) else []
        days = [name.removeprefix(f"{self.by}=") for name in names if name.startswith(f"{self.by}=")]
        return version, ["" if day == NULL_FOLDER else day for day in days]

    def replace(self, df, start, end, tasks=None, load=None, watch=None):
        """Makes `df` all that is stored from `start` to `end` (None: open); returns the commit.

        Dates of the range without rows lose theirs. Rows without a date replace such rows; without new ones they
        go only if the range is open on both sides. `load` is a record (see `append`).
        """
        version, days = self._written(df, tasks, watch)

        def change(found):
            for day in list(found["folders"]):
                if day in days or self._inside(day, start, end):
                    del found["folders"][day]
            for day in days:
                found["folders"][day] = [version]
            self._note(found, load, version)

        return self._commit(change, df.schema)

    def append(self, df, tasks=None, load=None, watch=None):
        """Adds rows to their dates; returns the commit.

        `load` is a function that gives, once the rows are written, the key of the load and its record. They are
        committed together with the rows. A load that is repeated takes the place of the one with its key.
        """
        version, days = self._written(df, tasks, watch)

        def change(found):
            before = self._note(found, load, version)
            for day, versions in list(found["folders"].items()):
                found["folders"][day] = [v for v in versions if v != before]
                if not found["folders"][day]:
                    del found["folders"][day]
            for day in days:
                found["folders"].setdefault(day, []).append(version)

        return self._commit(change, df.schema)

    def forget(self, start, end):
        """Drops the dates from `start` to `end`; returns the commit."""

        def change(found):
            found["folders"] = {day: v for day, v in found["folders"].items() if not self._inside(day, start, end)}

        return self._commit(change, self._schema(self.commit()))

    @staticmethod
    def _note(found, load, version):
        """Notes a load, and returns the version of the one that it repeats."""
        if load is None:
            return None
        key, record = load()
        before = found["loads"].get(key, {}).get("version")
        found["loads"][key] = {"version": version, "record": record}
        return before

    @staticmethod
    def _inside(day, start, end):
        if start is None and end is None:
            return True
        if day == "":
            return False
        day = date.fromisoformat(day)
        return (start is None or start <= day) and (end is None or day <= end)

    # --- reading ---------------------------------------------------------------

    def read(self, start=None, end=None, number=None):
        """The rows of a commit from `start` to `end` as a DataFrame; looks into the folders of these dates only.

        Rows without a date are there if the range is open. The commit is chosen now: what
        others write later does not show.
        """
        found = self.commit(number)
        if found["schema"] is None:
            raise FileNotFoundError(f"nothing has been committed at {self.path}")
        schema = self._schema(found)
        places = [
            f"{self.path}/data/version={version}/{self.by}={day or NULL_FOLDER}"
            for day, versions in found["folders"].items() for version in versions if self._inside(day, start, end)
        ]
        if not places:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.path}/data").schema(schema)
        return reader.parquet(*places).select(schema.fieldNames())

    def _schema(self, found):
        return StructType.fromJson(json.loads(found["schema"]))

    def dates(self):
        """The dates that have rows."""
        return sorted(date.fromisoformat(day) for day in self.commit()["folders"] if day)

    def loads(self):
        """The records of all loads, by key."""
        return {key: load["record"] for key, load in self.commit()["loads"].items()}

    def publish(self, table):
        """Shows the newest commit under a name of the catalog, which changes hands in one statement.

        Partitions are those of a table of this commit alone, and the name is a view of it.
        """
        found = self.commit()
        schema, own = self._schema(found), f"{table}__{found['number']}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"DROP TABLE IF EXISTS {own}")
        self.spark.sql(
            f"CREATE TABLE {own} ({columns}, `version` STRING) USING parquet "
            f"PARTITIONED BY (`version`, `{self.by}`) LOCATION '{self.path}/data'"
        )
        parts = [
            f"PARTITION (`version` = '{version}', `{self.by}` = {repr(day) if day else 'NULL'}) "
            f"LOCATION '{self.path}/data/version={version}/{self.by}={day or NULL_FOLDER}'"
            for day, versions in found["folders"].items() for version in versions
        ]
        for first in range(0, len(parts), PARTITIONS_AT_ONCE):
            self.spark.sql(f"ALTER TABLE {own} ADD {' '.join(parts[first : first + PARTITIONS_AT_ONCE])}")
        names = ", ".join(f"`{name}`" for name in schema.fieldNames())
        self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {names} FROM {own}")
        self._unpublish(table, found["number"])

    def _unpublish(self, table, number):
        """Forgets the tables of commits that are not kept."""
        *space, name = table.split(".")
        there = self.spark.sql(f"SHOW TABLES {'IN ' + '.'.join(space) if space else ''} LIKE '{name}__*'").collect()
        for row in there:
            end = row["tableName"].removeprefix(f"{name}__")
            if end.isdigit() and int(end) < number - self.keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {'.'.join([*space, row['tableName']])}")

    # --- deleting --------------------------------------------------------------

    def clean(self, now=None):
        """Deletes commits beyond those kept, and versions that no kept commit names.

        A version of no commit at all may be one that is being written, and stays for a week.
        """
        numbers = self.numbers()
        kept, old = numbers[-1 - self.keep :], numbers[: -1 - self.keep]
        named = lambda numbers: {v for n in numbers for vs in self.commit(n)["folders"].values() for v in vs}
        needed, past = named(kept), named(old)
        data, since = self._path("data"), ((now or time.time()) - ORPHAN_SECONDS) * 1000
        if past - needed or now:
            for status in self._files.listStatus(data):
                version = status.getPath().getName().removeprefix("version=")
                if version not in needed and (version in past or status.getModificationTime() < since):
                    self._files.delete(status.getPath(), True)
        for number in old:
            self._files.delete(self._path("_commits", f"{number:012d}.json"), False)


def land_by_date(df, path, by, day, key, tasks=None):
    """Adds a delivery to a copy that is stored by date; `day`, the DATE of each row, is worked out once.

    A report of one date then reads that date's folders, however long the history is. Rows whose date does not parse are
    stored without one. `key` names the delivery: landing it again replaces what it brought before.
    """
    return DatedVersions(df.sparkSession, path, by).append(df.withColumn(by, day), tasks, load=lambda: (key, {}))
