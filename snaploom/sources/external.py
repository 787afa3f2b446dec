"""Tables of an external service behind a transport that the caller injects: paged reads and guarded writes.

Pages are read in cursor order and checked for completeness. Writes compare and
set: a record is only written if it still has the expected values, and what was
written is read back.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str | None], dict]


class ExternalError(RuntimeError):
    pass


class ConflictError(ExternalError):
    def __init__(self, ids: list[str]):
        super().__init__(f"{len(ids)} records have neither the expected nor the desired values")
        self.ids = ids


class RateLimited(ExternalError):
    """Too many requests; ``after`` is how many seconds the service asks to wait, if it says so."""

    def __init__(self, after: float | None = None):
        super().__init__("too many requests")
        self.after = after


class AmbiguousWrite(ExternalError):
    """Records may or may not have been written, as no answer came; creating them again could double them."""

    def __init__(self, names: list[str]):
        super().__init__(f"no answer to a write of {len(names)} records")
        self.names = names


class NotAcknowledged(ExternalError):
    """The answer to a write doesn't name exactly the records and values that were sent."""


class SchemaChanged(ExternalError):
    pass


def retry_after(text: str | None, now: float | None = None) -> float | None:
    """Seconds to wait by a Retry-After header: a number, or a date; null if it is neither."""
    if not text or not text.strip():
        return None
    if re.fullmatch(r"[0-9]+(\.[0-9]+)?", text.strip()):
        return float(text)
    try:
        at = parsedate_to_datetime(text)
    except (TypeError, ValueError):
        return None
    return max(0.0, at.timestamp() - (time.time() if now is None else now))


def checked_schema(fields: list[dict], managed: dict[str, str]) -> dict[str, dict]:
    """The fields of a table by id; ids and names are unique, and every managed field is there with its type."""
    by_id = {f["id"]: f for f in fields}
    if len(by_id) != len(fields) or len({f["name"] for f in fields}) != len(fields):
        raise SchemaChanged("fields come twice")
    wrong = sorted(i for i, kind in managed.items() if i not in by_id or by_id[i].get("type") != kind)
    if wrong:
        raise SchemaChanged(f"missing or of another type: {', '.join(wrong)}")
    return by_id


def pages(fetch: Fetch, most: int = 100_000) -> Iterator[dict]:
    """Records of all pages; repeated ids or cursors and empty pages before the end are errors."""
    ids: set[str] = set()
    cursors: set[str] = set()
    cursor: str | None = None
    for _ in range(most):
        page = fetch(cursor)
        records = page.get("records")
        if not isinstance(records, list):
            raise ExternalError("a page has no list of records")
        for r in records:
            if r.get("id") in ids:
                raise ExternalError(f"record {r.get('id')} came twice")
            ids.add(r["id"])
            yield r
        cursor = page.get("offset")
        if cursor is None:
            return
        if cursor in cursors or not records:
            raise ExternalError("the pages don't go on")
        cursors.add(cursor)
    raise ExternalError("too many pages")


class PageFolder(DataSource):
    """``spark.read.format("page_folder").load(folder)``: one partition for each saved page, a JSON file of records."""

    @classmethod
    def name(cls) -> str:
        return "page_folder"

    def schema(self) -> str:
        return "id string, fields map<string,string>, page string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options["path"])


@dataclass
class _Page(InputPartition):
    path: str


class _PageReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder.removeprefix("file://")

    def partitions(self) -> list[_Page]:
        import os

        return [_Page(os.path.join(self.folder, n)) for n in sorted(os.listdir(self.folder)) if n.endswith(".json")]

    def read(self, partition: _Page) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8") as f:
            for r in json.load(f)["records"]:
                values = {k: v if isinstance(v, str) or v is None else json.dumps(v) for k, v in r.get("fields", {}).items()}
                yield r["id"], values, partition.path


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageFolder)


@dataclass(frozen=True)
class Update:
    record_id: str
    expected: dict[str, object]
    desired: dict[str, object]


@dataclass
class Writer:
    """``read(ids)`` gives the current fields by id, ``patch(rows)`` sets fields and may answer with what it set; ``post(rows)`` creates records and answers with their fields by id.

    Reads and patches that raise ``OSError`` or ``RateLimited`` are tried again, posts only if they were refused for their rate: a post
    without an answer may have been carried out. ``allowed`` names the fields that may be written, all if it is empty.
    """

    read: Callable[[list[str]], dict[str, dict]]
    patch: Callable[[dict[str, dict]], None]
    batch: int = 10
    attempts: int = 4
    pause: float = 0.25
    sleep: Callable[[float], None] = field(default=time.sleep)
    post: Callable[[list[dict]], dict[str, dict]] | None = None
    allowed: frozenset[str] = frozenset()
    longest: float = 60.0

    def _tried(self, call: Callable, *args, again: tuple[type[Exception], ...] = (OSError, RateLimited)):
        for n in range(self.attempts):
            try:
                return call(*args)
            except again as error:
                if n + 1 == self.attempts:
                    raise
                asked = error.after if isinstance(error, RateLimited) else None
                self.sleep(min(self.longest, self.pause * 2**n if asked is None else max(asked, self.pause)))

    def _may_write(self, rows: list[dict]) -> None:
        if self.allowed and (extra := sorted({f for r in rows for f in r} - self.allowed)):
            raise ExternalError(f"not to be written: {', '.join(extra)}")

    def create(self, rows: list[dict], key: str) -> dict[str, str]:
        """Creates records, each with a ``key`` of its own; gives the new ids by key. An answer has to repeat what was sent."""
        names = [str(r.get(key) or "") for r in rows]
        if "" in names or len(set(names)) != len(names):
            raise ExternalError("new records need keys of their own")
        self._may_write(rows)
        if self.post is None:
            raise ExternalError("this table takes no new records")
        ids: dict[str, str] = {}
        for at in range(0, len(rows), self.batch):
            some = rows[at : at + self.batch]
            try:
                answer = self._tried(self.post, some, again=(RateLimited,))
            except OSError as error:
                raise AmbiguousWrite(names[at : at + self.batch]) from error
            got = {str(v.get(key)): (i, v) for i, v in answer.items()}
            if len(answer) != len(some) or any(str(r[key]) not in got or any(got[str(r[key])][1].get(f) != v for f, v in r.items()) for r in some):
                raise NotAcknowledged("created records aren't those that were sent")
            ids |= {n: i for n, (i, _) in got.items()}
            self.sleep(self.pause)
        return ids

    def read_one(self, record_id: str) -> dict:
        found = self._tried(self.read, [record_id])
        if set(found) != {record_id}:
            raise ExternalError("another record came than was asked for")
        return found[record_id]

    def states(self, updates: list[Update]) -> dict[str, str]:
        now = self._tried(self.read, [u.record_id for u in updates])
        out = {}
        for u in updates:
            values = {k: now.get(u.record_id, {}).get(k) for k in u.desired}
            out[u.record_id] = "already_current" if values == u.desired else "pending" if values == {k: u.expected.get(k) for k in u.desired} else "conflict"
        return out

    def apply(self, updates: list[Update]) -> dict[str, int]:
        """Nothing is written if any record is in conflict; a batch is looked at again right before it is written."""
        if len({u.record_id for u in updates}) != len(updates) or any(u.expected.keys() != u.desired.keys() for u in updates):
            raise ExternalError("updates need distinct records and the same fields on both sides")
        self._may_write([u.desired for u in updates])
        written = 0
        first = self.states(updates)
        if bad := sorted(i for i, s in first.items() if s == "conflict"):
            raise ConflictError(bad)
        for at in range(0, len(updates), self.batch):
            some = updates[at : at + self.batch]
            state = self.states(some)
            if bad := sorted(i for i, s in state.items() if s == "conflict"):
                raise ConflictError(bad)
            todo = {u.record_id: u.desired for u in some if state[u.record_id] == "pending"}
            if todo:
                answer = self._tried(self.patch, todo)
                if answer is not None and (answer.keys() != todo.keys() or any(answer[i].get(f) != v for i, values in todo.items() for f, v in values.items())):
                    raise NotAcknowledged("patched records aren't those that were sent")
                self.sleep(self.pause)
                if any(s != "already_current" for s in self.states([u for u in some if u.record_id in todo]).values()):
                    raise ExternalError("what was written can't be read back")
                written += len(todo)
        return {"written": written, "already_current": len(updates) - written}
