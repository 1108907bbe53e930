"""``spark.read / readStream.format("queuelog")``: a topic as a Python data source.

A stream position is ``{"seq", "group", "cut", "known"}``: commits up to ``seq`` are read in
full, and of the commits in ``(seq, group]`` the messages up to ``cut``, in the order of store time,
then commit, then offset. A cut is ``[time, commit, j, k]``: all that was stored before the time
(microseconds), of that time what earlier commits hold, and of that commit the first j of k equal
parts of each queue's offsets. A trigger therefore ends at one store time for all queues and all
commits there are, even inside one, so a watermark moves no faster than the slowest queue. Messages
without time come before all others. A task reads one message file, or of a large one a run of row groups
that its statistics leave over, and only the columns of the schema given to the reader.

A topic is declared with the option keys of ``queuelog.options``, checked as everywhere, or by ``path``
and ``topic`` alone. Rows are messages with their bodies as stored; ``queuelog.formats.decode`` reads those.
A startup mode is resolved from the states that commits keep, and a tag goes into the parquet filter.

Classes here run in plain Python processes and take everything from their options.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from queuelog.model import LOG_SCHEMA
from queuelog.options import FORMAT, TOPIC, source_options

_DDL = (
    "topic string, broker_name string, queue_id int, queue_offset bigint, store_timestamp timestamp, "
    "tags string, body binary, headers map<string,binary>, msg_timestamp timestamp"
)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    # workers may not have this package on their path
    for name in (__name__, source_options.__module__):
        cloudpickle.register_pickle_by_value(sys.modules[name])
    spark.dataSource.register(QueueLogSource)


def starts_json(rows: list) -> str:
    return json.dumps([[r["broker_name"], r["queue_id"], r["offset"]] for r in rows])


#: The time of messages without one, and a commit after all others.
NO_TIME, LAST = -(2**63), 2**63 - 1


def _as_cut(cut) -> tuple | None:
    """A stored cut; before commits were part of it, it was a time."""
    if cut is None or isinstance(cut, list):
        return None if cut is None else tuple(cut)
    return cut, LAST, 1, 1


def side_of(cut: tuple, number: int, rows: list) -> tuple:
    """A cut as it meets a commit: its time, and which messages of that time lie before it: all, none, or
    those of each queue below an offset, as (broker, queue, offset)."""
    time, commit, j, k = cut
    if number != commit or j == k:
        return time, number <= commit
    return time, [(r["broker_name"], r["queue_id"], r["start"] + -(-j * (r["end"] - r["start"]) // k)) for r in rows if r["end"] > r["start"]]


#: Options that are not declarations of a table.
_OWN = {"path", "topic", "starts", "startup", "discovery", "maxmessagespertrigger", "maxpartitionbytes", "tag"}

#: Bytes of a file that a task reads, where the option ``maxPartitionBytes`` does not say otherwise.
PART_BYTES = 128 << 20

#: Bytes read ahead of a column, and encoded bytes of a batch's rows at most.
BUFFER_BYTES, BATCH_BYTES = 1 << 20, 16 << 20


def declared(options) -> dict:
    """Options of the format in one form, from table declarations or from its own names."""
    given = {name.lower(): value for name, value in options.items()}
    if TOPIC not in given:
        unknown = sorted(set(given) - _OWN)
        if unknown or not {"path", "topic"} <= set(given):
            raise ValueError(f"unknown option '{unknown[0]}'" if unknown else "options 'path' and 'topic' must be set")
        return given
    own = {name: given.pop(name, None) for name in ("maxmessagespertrigger", "maxpartitionbytes")}
    table = source_options({FORMAT: "raw", **given})
    return own | {
        "path": table.path, "topic": table.topic, "tag": table.tag, "discovery": str(table.discovery_interval_ms),
        "startup": table.startup_mode, "specific": table.specific_offsets, "millis": table.timestamp_millis,
        "group": table.group, "resolve": True,
    }


class FilePart(InputPartition):
    """Messages of one file after ``after`` and up to ``until``, both as ``side_of`` gives them,
    from all row groups or from those with the numbers ``groups``.

    ``skip`` lists (broker, queue, offset) below which messages are left out, ``drop`` whole
    queues; both only for queues of this file's commit.
    """

    def __init__(self, path: str, after=None, until=None, skip=(), drop=(), groups=None):
        super().__init__(path)
        self.path, self.after, self.until = path, after, until
        self.skip, self.drop, self.groups = list(skip), list(drop), groups

    def of_groups(self, groups: list[int]) -> FilePart:
        return FilePart(self.path, self.after, self.until, self.skip, self.drop, groups)


def of_queue(broker, number):
    """A parquet filter for the messages of a queue; null is a value like others."""
    import pyarrow.dataset as ds

    def equal(name, value):
        return ds.field(name).is_null() if value is None else ds.field(name).is_valid() & (ds.field(name) == value)

    return equal("broker_name", broker) & equal("queue_id", number)


class _Topic:
    """Commits of a topic and their files."""

    def __init__(self, options: dict):
        from pyarrow import fs

        path = options["path"].removeprefix("file://")
        if "://" in path:
            self.fs, root = fs.FileSystem.from_uri(path)
        else:
            self.fs, root = fs.LocalFileSystem(), path
        root = root.rstrip("/")
        self.name, self.tag, self.options = options["topic"], options.get("tag"), options
        self.groups = f"{root}/_groups/group={options.get('group')}/topic={self.name}"
        self.data = f"{root}/topic={self.name}"
        self.ranges = f"{root}/_ranges/topic={self.name}"
        self.marks = f"{root}/_commits/topic={self.name}"
        self._seen: dict[int, list] = {}  # commit number → state of the queues after it

    def _children(self, path: str):
        from pyarrow import fs

        return self.fs.get_file_info(fs.FileSelector(path, allow_not_found=True))

    def commits(self, after: int = -1) -> dict[int, str]:
        """Number → name of committed batches, in order."""
        names = sorted(info.base_name for info in self._children(self.marks) if not info.base_name.startswith("."))
        numbered = {int(name.split("-", 1)[0]): name for name in names}
        return {number: name for number, name in numbered.items() if number > after}

    def range_rows(self, number: int, name: str) -> list:
        """One row per queue known by then."""
        if number not in self._seen:
            import pyarrow.dataset as ds

            folder = ds.dataset(f"{self.ranges}/batch={name}", filesystem=self.fs, format="parquet")
            columns = ["broker_name", "queue_id", "start", "end", "ts_quantiles"]
            self._seen[number] = folder.to_table(columns=columns).to_pylist()
        return self._seen[number]

    def forget(self, number: int) -> None:
        """Commits up to this one are not needed again."""
        self._seen = {n: rows for n, rows in self._seen.items() if n > number}

    def forget_one(self, number: int) -> None:
        self._seen.pop(number, None)

    def queues(self) -> list:
        """Queues known now, for a list that is taken once."""
        commits = self.commits()
        if not commits:
            return []
        number = max(commits)
        return sorted((r["broker_name"], r["queue_id"]) for r in self.range_rows(number, commits[number]))

    def starts(self) -> list:
        """(broker, queue, offset) of every queue for a declared startup mode; nothing for all from the first."""
        o, commits = self.options, self.commits()
        if not o.get("resolve") or o["startup"] == "earliest-offset" or not commits:
            return []
        last = max(commits)
        found = {(r["broker_name"], r["queue_id"]): r["end"] for r in self.range_rows(last, commits[last])}
        if o["startup"] == "group-offsets":
            found |= {q: offset for q, offset in self._committed().items() if offset >= 0 and q in found}
        elif o["startup"] == "timestamp":
            found = dict.fromkeys(found, 0) | self._first_at(list(commits.values()), o["millis"])
        elif o["startup"] == "specific-offsets":
            for broker, queue in found:
                offset = o["specific"].get(queue, -1)
                if offset < 0:
                    name = "-".join(str(part) for part in (self.name, broker, queue) if part is not None)
                    raise ValueError(f"queue {name} needs an offset")
                found[broker, queue] = offset
        return [[broker, queue, offset] for (broker, queue), offset in found.items()]

    def _committed(self) -> dict:
        """Offsets of the group's last complete commit."""
        import pyarrow.dataset as ds

        numbers = (int(i.base_name.removeprefix("commit=")) for i in self._children(self.groups) if i.base_name.startswith("commit="))
        for number in sorted(numbers, reverse=True):
            folder = f"{self.groups}/commit={number}"
            if any(info.base_name == "_SUCCESS" for info in self._children(folder)):
                rows = ds.dataset(folder, filesystem=self.fs, format="parquet").to_table().to_pylist()
                return {(r["broker_name"], r["queue_id"]): r["offset"] for r in rows}
        return {}

    def _first_at(self, names: list[str], millis: int) -> dict:
        """First offset stored at or after a time, for the queues that have one.

        States name the batch with which a queue gets there; of that batch only row groups are opened whose
        statistics allow a smaller offset than the one found."""
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        at = pa.scalar(millis * 1000, pa.timestamp("us", "UTC"))

        def reached(name: str) -> list:
            folder = ds.dataset(f"{self.ranges}/batch={name}", filesystem=self.fs, format="parquet")
            columns = ["broker_name", "queue_id", "start", "end"]
            return folder.to_table(columns=columns, filter=ds.field("seen_ts") >= at).to_pylist()

        most, low, high = len(reached(names[-1])), 0, len(names) - 1
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if reached(names[middle]) else (middle + 1, high)
        found, left = {}, names[low:] if most else []
        for name in left:
            new = [(r["broker_name"], r["queue_id"]) for r in reached(name) if r["end"] > r["start"]]
            new = [queue for queue in new if queue not in found]
            parts = list(ds.dataset(f"{self.data}/batch={name}", filesystem=self.fs, format="parquet").get_fragments()) if new else []
            for queue in new:
                least = None
                for part in parts:
                    wanted = of_queue(*queue) & (ds.field("store_timestamp") >= at)
                    for group in part.split_by_row_group(wanted):
                        inside = wanted if least is None else wanted & (ds.field("queue_offset") < least)
                        for run in group.split_by_row_group(inside):
                            offset = pc.min(run.to_table(columns=["queue_offset"], filter=inside)["queue_offset"]).as_py()
                            least = offset if least is None or offset is not None and offset < least else least
                found[queue] = least
            if len(found) == most:
                break
        return found

    def files(self, names: list[str]) -> list[list[tuple[str, int]]]:
        """Message files of each batch and their sizes."""
        from concurrent.futures import ThreadPoolExecutor

        def of(name: str) -> list[tuple[str, int]]:
            found = self._children(f"{self.data}/batch={name}")
            return sorted((info.path, info.size) for info in found if info.base_name.endswith(".parquet"))

        with ThreadPoolExecutor(32) as pool:
            return list(pool.map(of, names))

    def _fragment(self, path: str):
        import pyarrow.dataset as ds

        return next(ds.dataset(path, filesystem=self.fs, format="parquet").get_fragments())

    def split(self, parts: list[tuple[FilePart, int]]) -> list[FilePart]:
        """Parts of files, given with their sizes, cut into runs of row groups where a file is large.

        Only large files are opened, for their footers; row groups without a message of the part are left out."""
        from concurrent.futures import ThreadPoolExecutor

        most = int(self.options.get("maxpartitionbytes") or PART_BYTES)

        def runs(part: FilePart, size: int) -> list[FilePart]:
            if size <= most:
                return [part]
            fragment = self._fragment(part.path)
            stored = sum(group.total_byte_size for group in fragment.row_groups)  # before compression
            found, held = [], 0
            for group in (g for one in fragment.split_by_row_group(self._wanted(part)) for g in one.row_groups):
                own = group.total_byte_size * size // max(stored, 1)
                if not found or held + own > most:
                    found, held = [*found, []], 0
                found[-1].append(group.id)
                held += own
            return [part.of_groups(ids) for ids in found]

        with ThreadPoolExecutor(32) as pool:
            return [run for cut in pool.map(lambda item: runs(*item), parts) for run in cut]

    def _wanted(self, part: FilePart):
        """The messages of a part as a parquet filter."""
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        def before(cut):
            """What lies before a cut; a message without time lies before every time."""
            moment, same = cut
            if moment == NO_TIME:
                first, at = pc.scalar(False), time.is_null()
            else:
                value = pa.scalar(moment, pa.timestamp("us", "UTC"))
                first, at = time.is_null() | (time < value), time.is_valid() & (time == value)
            if isinstance(same, bool):
                return first | at if same else first
            for broker, number, offset in same:
                first = first | (at & of_queue(broker, number) & (ds.field("queue_offset") < offset))
            return first

        wanted = pc.scalar(True)
        if self.tag:  # untagged messages pass
            tags = ds.field("tags")
            wanted = tags.is_null() | (tags == "") | (tags == self.tag)
        time = ds.field("store_timestamp")
        if part.after is not None:
            wanted &= ~before(part.after)
        if part.until is not None:
            wanted &= before(part.until)
        for broker, number, offset in part.skip:
            wanted &= ~(of_queue(broker, number) & (ds.field("queue_offset") < offset))
        for broker, number in part.drop:
            wanted &= ~of_queue(broker, number)
        return wanted

    def read(self, part: FilePart) -> Iterator:
        """Messages of a part; a row group is decoded a batch at a time, never as a whole."""
        import pyarrow as pa
        import pyarrow.parquet as pq

        names = self.options.get("columns") or LOG_SCHEMA.names
        stored = [name for name in names if name != "topic"]
        asked = ["tags"] if self.tag else []
        if part.after is not None or part.until is not None or part.skip or part.drop:
            asked += ["store_timestamp", "broker_name", "queue_id", "queue_offset"]
        fragment, wanted = self._fragment(part.path), self._wanted(part)
        if part.groups is not None:
            fragment = fragment.subset(row_group_ids=part.groups)
        groups = [group for one in fragment.split_by_row_group(wanted) for group in one.row_groups]
        with self.fs.open_input_file(part.path) as source:
            file = pq.ParquetFile(source, buffer_size=BUFFER_BYTES, pre_buffer=False)
            for group in groups:
                rows = max(1, min(8192, BATCH_BYTES * group.num_rows // max(group.total_byte_size, 1)))
                columns = list(dict.fromkeys([*stored, *asked])) or ["queue_offset"]
                for batch in file.iter_batches(rows, row_groups=[group.id], columns=columns, use_threads=False):
                    found = pa.Table.from_batches([batch])
                    for kept in (found.filter(wanted) if asked else found).to_batches():
                        if kept.num_rows:
                            topic = pa.array([self.name] * kept.num_rows, pa.string()) if "topic" in names else None
                            yield pa.RecordBatch.from_arrays([topic if n == "topic" else kept.column(n) for n in names], names=names)


def _read(options: dict, part: FilePart | None) -> Iterator:
    """A task's messages; a read without any file has one task and no part."""
    return iter(()) if part is None else _Topic(options).read(part)


class _BatchReader(DataSourceReader):
    """A stream's first trigger without a cap."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        stream = _StreamReader({**self.options, "maxmessagespertrigger": None})
        return stream.partitions(stream.initialOffset(), stream.latestOffset())

    def read(self, partition):
        return _read(self.options, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = {name.lower(): value for name, value in options.items()}
        self.topic = _Topic(self.options)
        cap = self.options.get("maxmessagespertrigger")
        self.cap = int(cap) if cap else None
        self.last: dict | None = None  # position up to which batches are planned
        self.marks: dict = {}  # commit number → store times not read yet and the messages up to each

    def initialOffset(self) -> dict:
        starts = self.options.get("starts")
        frozen = int(self.options.get("discovery", "-1")) < 0
        return {
            "seq": -1, "group": -1, "cut": None,
            # kept in the checkpoint, so a restart does not resolve them anew
            "starts": json.loads(starts) if starts else self.topic.starts(),
            "known": self.topic.queues() if frozen else None,
        }

    def latestOffset(self) -> dict:
        here = self.last or self.initialOffset()
        if self.cap is None and here["cut"] is None:
            end = max(self.topic.commits(here["seq"]), default=here["seq"])
            self.last = {**here, "seq": end, "group": end}
        else:
            self.last = self._capped(here)
        return self.last

    def _capped(self, here: dict) -> dict:
        """End where ``cap`` messages are reached, by prefix sums over what commits say of their store times."""
        import numpy as np

        commits = self.topic.commits(here["seq"])
        group = max(commits, default=here["seq"])
        for number, name in commits.items():
            if number not in self.marks:
                self.marks[number] = self._slices(number, name)
        self.marks = {n: self.marks[n] for n in commits}
        begun, part = _as_cut(here["cut"]), 1.0
        if begun is not None:
            for number in commits:
                if number <= here["group"]:
                    time, share = self.marks[number]
                    left = time > begun[0] if number < begun[1] or number == begun[1] and begun[2] == begun[3] else time >= begun[0]
                    self.marks[number] = time[left], share[left]
            part = 1 - begun[2] / begun[3]
        empty = np.empty(0, "int64")
        time = np.concatenate([empty, *(t for t, _ in self.marks.values())])
        number = np.concatenate([empty, *(np.full(len(t), n) for n, (t, _) in self.marks.items())])
        share = np.concatenate([np.empty(0), *(s for _, s in self.marks.values())])
        order = np.lexsort((number, time))
        time, number, share = time[order], number[order], share[order]
        inside = begun is not None and begun[2] < begun[3] and len(time) > 0 and (time[0], number[0]) == begun[:2]
        upto = np.cumsum(np.append(share[:1] * (part if inside else 1), share[1:]))
        if self.cap is None or not len(time) or upto[-1] <= self.cap:
            return {**here, "seq": group, "group": group, "cut": None}
        fits = int(np.searchsorted(upto, self.cap + 1e-6, "right"))
        if fits:
            cut = [int(time[fits - 1]), int(number[fits - 1]), 1, 1]
        elif inside:
            cut = [*begun[:2], begun[2] + 1, begun[3]]
        else:  # more messages of one time and commit than the cap
            cut = [int(time[0]), int(number[0]), 1, int(-(-share[0] // self.cap))]
        if cut[2] == cut[3]:
            cut[2:] = 1, 1
        seq = here["seq"]
        for n in commits:  # the first ones may be read in full by then
            times = self.marks[n][0]
            if len(times) and (int(times[-1]), n) > (cut[0], cut[1]) or n == cut[1] and cut[2] < cut[3]:
                break
            seq = n
        return {**here, "seq": seq, "group": group, "cut": cut}

    def _slices(self, number: int, name: str) -> tuple:
        """Store times of a commit, ascending, and messages up to each since the one before, by its stored
        quantiles; a queue without any time has all its messages at the first."""
        import numpy as np

        times, shares = [], []
        for row in self.topic.range_rows(number, name):
            marks = row["ts_quantiles"] or [NO_TIME]
            if row["end"] > row["start"]:
                times += marks
                shares += [(row["end"] - row["start"]) / len(marks)] * len(marks)
        self.topic.forget_one(number)
        time, at = np.unique(np.array(times, dtype="int64"), return_inverse=True)
        return time, np.bincount(at, np.array(shares, dtype="float64"), len(time)) if len(time) else np.empty(0)

    def partitions(self, start: dict, end: dict):
        if self.last is None:  # first call after a restart
            self.last = end
        starts = {(broker, queue): offset for broker, queue, offset in end["starts"] if offset > 0}
        commits = [(n, name) for n, name in self.topic.commits(start["seq"]).items() if n <= end["group"]]
        if not commits:
            return []

        def ends(i: int) -> dict:
            return {(r["broker_name"], r["queue_id"]): r["end"] for r in self.topic.range_rows(*commits[i])}

        # what a queue holds only grows, so commits before the first one that gets past a start are skipped
        low, high = 0, len(commits)
        while starts and low < high:
            middle = (low + high) // 2
            past = any(offset > starts.get(queue, 0) for queue, offset in ends(middle).items())
            low, high = (low, middle) if past else (middle + 1, high)
        commits = commits[low:]
        if not commits:
            return []
        foreign = set()
        if end["known"] is not None:
            foreign = set(ends(-1)) - {tuple(q) for q in end["known"]}
        parts = []
        for (number, name), paths in zip(commits, self.topic.files([name for _, name in commits])):
            skip, drop = [], []
            if starts or foreign:
                rows = self.topic.range_rows(number, name)
                own = {(r["broker_name"], r["queue_id"]): r for r in rows if r["end"] > r["start"]}
                skip = [(*q, starts[q]) for q, r in own.items() if r["start"] < starts.get(q, 0)]
                drop = [q for q in own if q in foreign]
                # starts that are behind us need no look at later commits
                reached = {(r["broker_name"], r["queue_id"]): r["end"] for r in rows}
                starts = {q: o for q, o in starts.items() if reached.get(q, 0) < o}
            rows = self.topic.range_rows(number, name) if start["cut"] or end["cut"] else []
            after, until = _as_cut(start["cut"]), _as_cut(end["cut"])
            after = side_of(after, number, rows) if after and number <= start["group"] else None
            until = side_of(until, number, rows) if until and number > end["seq"] else None
            parts += [(FilePart(path, after, until, skip, drop), size) for path, size in paths]
        return self.topic.split(parts)

    def read(self, partition):
        return _read(self.options, partition)

    def commit(self, end: dict) -> None:
        self.topic.forget(end["seq"])


def _with_columns(options: dict, schema) -> dict:
    """Options with the columns to read: all, or those of the schema that the reader was given."""
    types = {field.name: field.dataType for field in LOG_SCHEMA}
    for field in schema:
        if types.get(field.name) != field.dataType:
            raise ValueError(f"messages have no column '{field.name}' of type {field.dataType.simpleString()}")
    return {**options, "columns": schema.names}


class QueueLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "queuelog"

    def schema(self):
        return _DDL

    def reader(self, schema):
        return _BatchReader(_with_columns(declared(self.options), schema))

    def streamReader(self, schema):
        return _StreamReader(_with_columns(declared(self.options), schema))
