"""Deduplicating new batches against all that was accepted before.

A record is a set of up to six tokens: place, day, number, site (house and
unit), parcel and point. Two records of one permit share at least three of
them, so records with fewer than three are neither indexed nor asked for. Tokens are ordered by
rarity: numbers, parcels and points come first as long as few records hold
them, then those that many hold, together with places, days and houses. The
prefix of rare tokens is indexed token by token. Records that meet in no rare
token share three frequent ones, and only such threes are indexed for
frequent tokens, never a frequent token on its own. A token becomes frequent
when more than ``RARE`` records hold it; the records holding it then are indexed
by their threes as well, so that what is met never depends on the order of the
batches, and no token pairs up more than so many records.

The index is an inverted one, kept in the folder given, bucketed by token.
A batch is read once, probes the index with its own tokens only, counts the tokens
that both records of a candidate share, verifies those with three or more on
all parts, and appends its postings. Postings carry ten bits of each token to
count with, so the parts of accepted records are fetched for candidates only.
The verified links of all batches are
consolidated, and each group's first record is the one first accepted.

A batch counts once a manifest names it, which is written last: what a lost
driver left half written is overwritten, a batch given again changes
nothing, and a later session goes on from the same folder. ``compact``
rewrites the files of many batches into fewer, in as many buckets as wanted.

Records of a batch whose parts are all alike, and enough for a repeat, are
indexed once, so that copies, even of a third of all rows, cost one posting each
token. Parcels, and points without an address, only let records meet if one of them has no
address, as only then they decide; large projects on one parcel therefore don't pair up.

Defined results: a part that is null, blank or a stand-in is a gap and agrees
with nothing; records with fewer than three parts repeat nothing; a null batch
comes before all others; an empty table gives no rows; extra columns are
ignored; rows repeated under one source_index are one record, with the parts of each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaploom.llm import addresses
from snaploom.llm.canonical import FRAME, LONG, NONE, Matcher, entries_of, fold, matcher_of
from snaploom.llm.components import components
from snaploom.storage import discard, new_path, remove, saved

PARTS = "row bigint, place string, day date, number string, house string, unit string, direction string, kind string, street string, parcel string, point string"
COLUMNS = [p.split()[0] for p in PARTS.split(", ")]
# fixed values: words that aren't part of a number
NOISE = re.compile(r"\b(?:PERMIT|PERMITS|NUMBER|NUM|NO)\b")
NOISES = {"PERMIT", "PERMITS", "NUMBER", "NUM", "NO"}
#: The usual forms, which need none of the steps that odd ones do: letters that don't end with an O, a year, a dash and a running number.
USUAL = re.compile(r"((?:[A-Z]*[A-NP-Z])?)-?([0-9]{2}|(?:19|20)[0-9]{2})-([0-9]+)")
ZEROS = re.compile(r"(?<=[0-9])O+|O+(?=[0-9])")
DIGITS, LETTERS = re.compile(r"[0-9]+"), re.compile(r"[A-Z]+")
# fixed values: entries for a place that name none
NO_PLACE = {"", "NA", "N A", "NONE", "NULL", "TBD", "TEST", "STATE", "COUNTY", "CITY", "UNKNOWN", "VARIOUS", "MULTIPLE", "MULTIPLE CITIES", "SEE NOTES", "NOT LISTED", "OTHER"}
NO_ADDRESS = addresses.Address(None, None, None, None, None)  # type: ignore[arg-type]
#: Days that a date may be off where everything else agrees.
NEAR_DAYS = 3
#: Tokens that two records of one permit share at least.
OVERLAP = 3
#: Records that may hold a token for it to be rare.
RARE = 64
#: Frequent tokens that are sent along as literals; more of them are joined.
FEW = 1000
BASE = ("place", "day", "number", "site", "parcel", "point")
#: The kinds whose tokens may be rare, the rarest first.
SELECTIVE = ("number", "point", "parcel")
#: The threes of tokens that suffice for a repeat, and whether only with a record without an address.
THREES = (
    (("place", "day", "number"), False), (("place", "day", "site"), False), (("place", "day", "point"), True),
    (("place", "number", "site"), False), (("place", "number", "parcel"), True), (("place", "number", "point"), True),
    (("day", "number", "site"), False), (("day", "number", "parcel"), True), (("day", "number", "point"), True),
    (("place", "site", "point"), False), (("place", "parcel", "point"), True), (("day", "site", "point"), False), (("number", "site", "point"), False),
)
#: A posting is a token, a record, and in one number ten bits of each of the record's tokens and what is known of the posting.
POSTING = "token bigint, row bigint, marks bigint"
BITS = 10
BARE, WITH_BARE, SINGLE, FRESH = (1 << i for i in range(BITS * len(BASE), BITS * len(BASE) + 4))


def number_key(text: str | None) -> str | None:
    """A tracking number in comparable form: letters, two-digit year, and running number without zeros in front.

    Case, separators, a letter O for a zero, and words around it don't matter.
    """
    if not text:
        return None
    usual = USUAL.fullmatch(text)
    if usual and usual[1] not in NOISES:
        letters, year, rest = usual.groups()
        rest = rest.lstrip("0")
        return f"{letters}|{year[-2:]}|{rest or '0'}" if rest or year.strip("0") else None
    up = addresses.plain(text)
    if "P" in up or "N" in up:
        up = NOISE.sub(" ", up)
    if "O" in up:
        up = ZEROS.sub(lambda m: "0" * len(m[0]), up)
    digits = DIGITS.findall(up)
    if not digits or not "".join(digits).strip("0"):
        return None
    letters = "".join(LETTERS.findall(up))
    if len(digits) == 1:
        d = digits[0]
        at = 4 if len(d) >= 8 and d[:2] in ("19", "20") else 2
        digits = [d[:at], d[at:]] if len(d) > at else [d]
    year, rest = digits[0], "".join(digits[1:])
    if len(year) == 4 and year[:2] in ("19", "20"):
        year = year[2:]
    return f"{letters}|{year}|{rest.lstrip('0') or '0'}" if rest else f"{letters}|{year}"


def place_key(matcher: Matcher, typed: str | None, *texts: str | None) -> str | None:
    """The listed place a record is in, or else the unlisted one as typed; without either, the place that its address ends with."""
    tokens = fold(typed) if typed else []
    if tokens and " ".join(tokens) not in NO_PLACE and not tokens[0].isdigit():
        found = matcher.resolve(typed)
        return found if found != NONE else "?" + " ".join(t for t in (LONG.get(t, t) for t in tokens) if t not in FRAME)
    for text in texts:
        pieces = [p for p in (text or "").split(",") if p.strip() and " ".join(fold(p)) not in addresses.STATES]
        if len(pieces) > 1:
            found = matcher.resolve(pieces[-1].strip())
            if found != NONE:
                return found
    return None


def _parcel(c: Column) -> Column:
    """A parcel number as one run of digits and letters, with or without separators, zeros in front left out."""
    whole = F.regexp_replace(F.regexp_replace(F.upper(c), "[^A-Z0-9]", ""), "^(APN)?0*", "")
    return F.when(whole.rlike("[0-9]"), whole)


def _point(north: Column, east: Column) -> Column:
    both = [F.trim(c.cast("string")) for c in (north, east)]
    return F.when((both[0] != "") & (both[1] != ""), F.concat_ws(",", *both))


def read_parts(rows: DataFrame, entries: Broadcast) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(entries.value)
        for batch in batches:
            out = []
            for typed, number, street, standard in zip(*(batch.column(c).to_pylist() for c in ("typed", "tracking", "street_text", "standard_text"))):
                place = matcher.exact.get(typed) or place_key(matcher, typed, standard, street)
                near = place.removeprefix("?") if place else None
                a = addresses.parse(street, near) or addresses.parse(standard, near) or NO_ADDRESS
                out.append((place, number_key(number), *a[:2], a.unit, a.kind, a.street))
            read = dict(zip(("place", "number", "house", "direction", "unit", "kind", "street"), zip(*out))) if out else {}
            # what needs no reading passes through as it is
            yield pa.RecordBatch.from_arrays([batch.column(c) if c in ("row", "day", "parcel", "point") else pa.array(read.get(c, ()), pa.string()) for c in COLUMNS], COLUMNS)

    kept = rows.select(
        F.col("source_index").cast("bigint").alias("row"), F.col("permit_date").alias("day"), F.coalesce(_parcel(F.col("raw_apn")), _parcel(F.col("formatted_apn"))).alias("parcel"), _point(F.col("latitude"), F.col("longitude")).alias("point"),
        F.col("jurisdiction").alias("typed"), F.col("tracking_raw").alias("tracking"), F.col("street_address").alias("street_text"), F.col("standard_address").alias("standard_text"),
    )
    return kept.mapInArrow(read, PARTS)


# The expressions below are SQL texts, as building them column by column costs more than a small batch.
#: What a token of each kind stands for; a site is a house and unit, or a street without a house.
VALUES = {b: b for b in BASE} | {"site": "if(street is null, null, concat_ws('|', coalesce(house, concat('~', street)), coalesce(unit, '')))"}


def _token(*kinds: str) -> str:
    """One token, or several as one; null unless all are there."""
    values = [VALUES[k] for k in kinds]
    return f"if({' or '.join(f'{v} is null' for v in values)}, null, xxhash64('{'|'.join(kinds)}', {', '.join(values)}))"


#: Records with fewer tokens can't share enough with any other.
LONG_ENOUGH = f"{' + '.join(f'int({v} is not null)' for v in VALUES.values())} >= {OVERLAP}"


def postings(parts: DataFrame, fresh: str = "true", about: str | None = None) -> DataFrame:
    """A record's postings: its tokens that may be rare, and the threes of its frequent ones.

    The array ``often`` has the kinds of SELECTIVE whose token is frequent in the
    record. With ``about``, another such array, only the threes that have one of its kinds.
    """
    found = [f"named_struct('token', {_token(k)}, 'with_bare', {k == 'parcel'}, 'single', true)" for k in SELECTIVE] if about is None else []
    for kinds, with_bare in THREES:
        selective = [k for k in kinds if k in SELECTIVE]
        if about is None or selective:
            wanted = [f"array_contains(often, '{k}')" for k in selective] + ([f"arrays_overlap({about}, array({', '.join(map(repr, selective))}))"] if about else [])
            token = f"if({' and '.join(wanted)}, {_token(*kinds)}, null)" if wanted else _token(*kinds)
            found.append(f"named_struct('token', {token}, 'with_bare', {with_bare}, 'single', false)")
    # no token is all zeros
    own = " | ".join(f"shiftleft(bigint(if({v} is null, 0, 1 + pmod(hash({v}), {2**BITS - 1}))), {BITS * i})" for i, v in enumerate(VALUES.values()))
    own += f" | if(street is null, {_long(BARE)}, 0L) | if({fresh}, {_long(FRESH)}, 0L)"
    each = parts.where(LONG_ENOUGH).selectExpr("row", f"{own} as own", f"inline(array({', '.join(found)}))").where("token is not null")
    return each.selectExpr("token", "row", f"own | if(with_bare, {_long(WITH_BARE)}, 0L) | if(single, {_long(SINGLE)}, 0L) as marks")


def _long(bits: int) -> str:
    """The number with these bits as a literal."""
    return f"{bits - 2**64 if bits >= 2**63 else bits}L" if bits != 2**63 else "shiftleft(1L, 63)"


def _has(flag: int, marks: str = "marks") -> str:
    return f"({marks} & {_long(flag)}) <> 0"


def _shared(a: str, b: str) -> str:
    """How many tokens two records share by their marks."""
    masks = [_long((2**BITS - 1) << BITS * i) for i in range(len(BASE))]
    return " + ".join(f"int((({a} ^ {b}) & {m}) = 0 and ({a} & {m}) <> 0)" for m in masks)


def _repeats(itself: bool = False) -> str:
    """Whether the parts of ``a_`` and ``b_`` columns are those of one permit; or of a record and its like, by the record's own columns.

    One of place, day, number and site may be wrong or missing if the others
    agree. Without an address the parcel stands for the site; where the number
    disagrees as well, the coordinates have to be the same, as siblings share a
    parcel and a day. Equal coordinates beside an equal address or parcel also
    let two of the parts be missing or slightly off.
    """

    def same(part: str) -> str:
        return f"({part} is not null)" if itself else f"coalesce(a_{part} = b_{part}, false)"

    def gap(part: str) -> str:
        return f"({part} is null)" if itself else f"(a_{part} is null or b_{part} is null)"

    place, day, number, parcel, point = map(same, ("place", "day", "number", "parcel", "point"))
    loose = " and ".join(f"({gap(p)} or a_{p} = b_{p})" for p in ("direction", "kind"))
    address = same("street") if itself else f"(a_house <=> b_house and a_unit <=> b_unit and {loose} and coalesce(levenshtein(a_street, b_street, 2) >= 0, false))"
    bare = gap("street")
    site = f"({address} or ({bare} and ({parcel} or ({point} and {gap('parcel')}))))"
    close_day = "true" if itself else f"({gap('day')} or abs(datediff(a_day, b_day)) <= {NEAR_DAYS})"
    close_number = "true" if itself else f"({gap('number')} or levenshtein(a_number, b_number, 1) >= 0)"
    ways = (
        f"{place} and {day} and {number}",
        f"{place} and {day} and ({address} or ({site} and {point}))",
        f"{place} and {number} and {site}",
        f"{day} and {number} and {site}",
        f"{place} and ({address} or ({bare} and {parcel})) and {point} and {close_day} and {close_number}",
        f"{gap('place')} and ({day} or {number}) and {address} and ({gap('parcel')} or {parcel}) and {point}",
    )
    return " or ".join(f"({w})" for w in ways)


REPEATS, REPEATS_ITSELF = _repeats(), _repeats(itself=True)


class RepeatIndex:
    """What was accepted so far: parts by row and postings by token, both kept in buckets and only ever appended to.

    A step shuffles its own records and candidates; accepted ones are read where they lie.
    """

    TABLES = {"parts": (PARTS, "row"), "postings": (POSTING, "token")}

    def __init__(self, spark: SparkSession, listed: DataFrame, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.entries = spark.sparkContext.broadcast(tuple(entries_of(listed)))
        self.temporary = path is None
        self.path = (path or new_path(spark, "repeats")).rstrip("/")
        self.buckets = buckets or spark.sparkContext.defaultParallelism
        self.generation = self.steps = self.commits = self.counted = 0
        self.batches: dict[str, int] = {}
        self._read_manifest()
        self._open()

    # what is committed

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read_manifest(self) -> None:
        folder = self._at(f"{self.path}/manifest")
        names = [f.getPath().getName() for f in self._fs().listStatus(folder)] if self._fs().exists(folder) else []
        last = max((n for n in names if n.endswith(".json")), default=None)
        if last:
            told = json.loads(self.spark.read.text(f"{self.path}/manifest/{last}", wholetext=True).first()[0])
            self.commits = int(last.removesuffix(".json")) + 1
            self.buckets, self.generation, self.steps, self.counted, self.batches = (told[k] for k in ("buckets", "generation", "steps", "counted", "batches"))

    def _commit(self) -> None:
        """Writes the next manifest under another name and renames it, which it does once or not at all."""
        told = {"buckets": self.buckets, "generation": self.generation, "steps": self.steps, "counted": self.counted, "batches": self.batches}
        name = f"{self.path}/manifest/{self.commits:08d}"
        out = self._fs().create(self._at(f"{name}.part"), True)
        try:
            out.write(bytearray(json.dumps(told).encode()))
        finally:
            out.close()
        if not self._fs().rename(self._at(f"{name}.part"), self._at(f"{name}.json")):
            raise RuntimeError(f"{name}.json is there already: another session writes to this index")
        self.commits += 1

    def _name(self, what: str) -> str:
        return f"snaploom_{re.sub(r'[^A-Za-z0-9]', '_', self.path[-80:])}_{self.generation}_{what}"

    def _folder(self, what: str) -> str:
        return f"{self.path}/{what}-{self.generation}"

    def _open(self) -> None:
        for what, (columns, key) in self.TABLES.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(what)}")
            self.spark.sql(f"CREATE TABLE {self._name(what)} ({columns.replace('row bigint', '`row` bigint')}, step int) USING parquet PARTITIONED BY (step) CLUSTERED BY (`{key}`) INTO {self.buckets} BUCKETS LOCATION '{self._folder(what)}'")
            if self.steps:
                self.spark.sql(f"MSCK REPAIR TABLE {self._name(what)}")

    def _table(self, what: str) -> DataFrame:
        """The committed rows and those of the step under way."""
        return self.spark.table(self._name(what)).where(F.col("step") <= self.steps)

    def _append(self, what: str, rows: DataFrame) -> None:
        # the step is no column of the rows, so that the code generated for them is the same in every step
        placed = rows.repartition(self.buckets, self.TABLES[what][1])
        self.spark.sql(f"INSERT INTO {self._name(what)} PARTITION (step = {self.steps}) SELECT * FROM {{placed}}", placed=placed)

    def _frequent(self) -> DataFrame | None:
        """(token) of the tokens that are frequent by now; none if there is no such token."""
        folder = self._at(f"{self.path}/frequent")
        names = [f.getPath().getName() for f in self._fs().listStatus(folder)] if self._fs().exists(folder) else []
        names = sorted(n for n in names if int(n.split("-")[0]) <= self.steps)
        return self.spark.read.schema("token bigint").parquet(*[f"{self.path}/frequent/{n}" for n in names]) if names else None

    def _with_often(self, parts: DataFrame, tokens: DataFrame | None, name: str = "often") -> DataFrame:
        """Adds the kinds whose token is one of ``tokens``."""
        if tokens is None:
            return parts.withColumn(name, F.array().cast("array<string>"))
        few = tokens.limit(FEW + 1).collect()
        if len(few) <= FEW:
            listed = ", ".join(f"{r[0]}L" if r[0] != -(2**63) else "bigint('-9223372036854775808')" for r in few) or "null"
            return parts.withColumn(name, F.array_compact(F.array(*[F.expr(f"if({_token(k)} in ({listed}), '{k}', null)") for k in SELECTIVE])))
        hits = tokens.selectExpr("token as asked", "true as hit")  # one small table for all three joins
        for k in SELECTIVE:
            parts = parts.withColumn("asked", F.expr(_token(k))).join(hits, "asked", "left").drop("asked").withColumnRenamed("hit", f"hit_{k}")
        return parts.withColumn(name, F.array_compact(F.array(*[F.expr(f"if(hit_{k}, '{k}', null)") for k in SELECTIVE]))).drop(*[f"hit_{k}" for k in SELECTIVE])

    def _promote(self, singles: DataFrame, name: str) -> None:
        """Makes those of the tokens frequent that more than RARE records hold, and indexes the records holding them by their threes."""
        frequent, path = self._frequent(), f"{self.path}/frequent/{name}"
        often = singles.groupBy("token").agg(F.count("*").alias("n")).where(f"n > {RARE}").select("token")
        new = saved((often if frequent is None else often.join(frequent, "token", "left_anti")).hint("rebalance"), "frequent", path)
        if new.isEmpty():
            remove(self.spark, path)
            return
        rows = self._table("postings").where(_has(SINGLE)).join(new, "token", "left_semi").select("row").repartition(self.buckets, "row").distinct()
        held = self._with_often(self._table("parts").join(rows, "row", "left_semi"), new, "now_often")
        self._append("postings", postings(self._with_often(held, self._frequent()), f"step = {self.steps}", "now_often"))

    def _size(self) -> int:
        """Bytes of the accepted parts."""
        return self._fs().getContentSummary(self._at(self._folder("parts"))).getLength()

    def accept(self, batch: DataFrame, name: str | None = None) -> DataFrame:
        """Checks a batch against all accepted rows and itself, and adds it; gives its (a, b) links, a < b.

        A batch of a name that was accepted before isn't read again.
        """
        if name is not None and name in self.batches:
            return self._links(self.batches[name])
        step, here = self.steps, f"step = {self.steps}"
        for what in self.TABLES:  # what a lost session left of this step
            remove(self.spark, f"{self._folder(what)}/step={step}")
        remove(self.spark, f"{self.path}/frequent/{step}-a")
        remove(self.spark, f"{self.path}/frequent/{step}-b")
        self._append("parts", read_parts(batch, self.entries))
        parts = self._table("parts").where(here).select(*COLUMNS)
        # records alike share the hash of all parts and a second one as check; the aggregate sends one row per task for a hot one.
        # Records that aren't copies of one another though alike, such as siblings on a parcel, go through the index.
        signs = [f"xxhash64({seed}, {', '.join(f'coalesce(string({c}), chr(0))' for c in COLUMNS[1:])}) as sign{seed}" for seed in (1, 2)]
        signed = parts.where(f"{LONG_ENOUGH} and ({REPEATS_ITSELF})").selectExpr("row", *signs)
        twice = signed.groupBy("sign1", "sign2").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        # saved, so that the planner knows how few they are before it shuffles the batch for them
        twice = saved(twice.hint("rebalance"), "twice", f"{self.path}/twice/{step}")
        copies = saved(signed.join(twice, ["sign1", "sign2"]).where("row <> first").selectExpr("first as a", "row as b"), "copies", f"{self.path}/copies/{step}")
        firsts = parts.join(copies.select(F.col("b").alias("row")), "row", "left_anti")
        self._append("postings", postings(self._with_often(firsts, self._frequent())))
        singles = self._table("postings").where(_has(SINGLE))
        self._promote(singles.where(here).select("token"), f"{step}-a")
        saved(self._verified(step).hint("rebalance"), "links", f"{self.path}/links/{step}")
        for what in ("twice", "pairs", "ends"):
            remove(self.spark, f"{self.path}/{what}/{step}")
        # tokens become frequent by adding up too; to count them all each time the index has grown by half is enough, as this changes no result
        size = self._size()
        if not step:
            self.counted = size
        elif 2 * size > 3 * self.counted:
            self.counted = size
            self._promote(singles.select("token"), f"{step}-b")
        if name is not None:
            self.batches[name] = step
        self.steps += 1
        self._commit()
        return self._links(step)

    def candidates(self, step: int) -> DataFrame:
        """(b, a): a record of the step and one accepted before, or before it in the step, that share enough tokens."""
        index, frequent = self._table("postings"), self._frequent()
        own = index.where(f"step = {step} and {_has(FRESH)}").selectExpr("token", "row", "step as at", "marks")
        if frequent is not None:  # their threes are asked for instead
            own = own.join(frequent, "token", "left_anti")
        other = index.selectExpr("token", "row as row2", "step", "marks as marks2")
        bare = f"not {_has(WITH_BARE, 'marks2')} or {_has(BARE)} or {_has(BARE, 'marks2')}"
        met = own.join(other, "token").where(f"row2 <> row and (step < at or row2 < row) and ({bare}) and {_shared('marks', 'marks2')} >= {OVERLAP}")
        # in as many partitions as there are buckets, or the planner would shuffle the accepted parts too
        return met.selectExpr("row as b", "row2 as a").repartition(self.buckets, "b").distinct()

    def _verified(self, step: int) -> DataFrame:
        """(a, b) of the candidates that are repeats; saved on the way, so that the planner knows how few they are and leaves the parts where they lie."""
        pairs = saved(self.candidates(step).hint("rebalance"), "pairs", f"{self.path}/pairs/{step}")
        asked = pairs.selectExpr("inline(array(named_struct('row', a), named_struct('row', b)))").repartition(self.buckets, "row").distinct()
        ends = saved(self._table("parts").join(asked, "row", "left_semi").select(*COLUMNS).hint("rebalance"), "ends", f"{self.path}/ends/{step}")
        a, b = (ends.selectExpr(*[f"{c} as {x}_{c}" for c in COLUMNS]) for x in "ab")
        met = pairs.join(b, F.col("b") == F.col("b_row")).join(a, F.col("a") == F.col("a_row"))
        return met.where(REPEATS).selectExpr("least(a, b) as a", "greatest(a, b) as b")

    def _links(self, step: int) -> DataFrame:
        return self.spark.read.schema("a bigint, b bigint").parquet(f"{self.path}/links/{step}", f"{self.path}/copies/{step}")

    def compact(self, buckets: int | None = None) -> None:
        """Rewrites the tables of all steps as one, in as many buckets as given; rare postings of frequent tokens are left out."""
        old, frequent = {w: self._folder(w) for w in self.TABLES}, self._frequent()
        kept = {w: self._table(w).drop("step") for w in self.TABLES}
        if frequent is not None:
            rare = kept["postings"].where(_has(SINGLE)).join(frequent, "token", "left_anti")
            kept["postings"] = rare.unionAll(kept["postings"].where(f"not ({_has(SINGLE)})"))
        names = [self._name(w) for w in self.TABLES]
        self.generation, self.buckets, steps = self.generation + 1, buckets or self.buckets, self.steps
        for what in self.TABLES:
            remove(self.spark, self._folder(what))
        self.steps = 0
        self._open()
        for what, rows in kept.items():
            self._append(what, rows.select(*[c.split()[0] for c in self.TABLES[what][0].split(", ")]))
        self.steps = steps
        self._commit()
        for name, folder in zip(names, old.values()):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, folder)

    def close(self) -> None:
        """Takes the tables out of the session. The files stay; of an index without a folder of its own, only links and copies, for results not read yet."""
        for what in self.TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(what)}")
            if self.temporary:
                remove(self.spark, self._folder(what))

    def groups(self) -> DataFrame:
        """(row, first): each accepted row that is linked to others, and the first row of its group."""
        if not self.steps:
            return self.spark.createDataFrame([], "row bigint, first bigint")
        # copies hang on their first row, the smallest of them
        return components(reduce(DataFrame.unionAll, [self._links(s) for s in range(self.steps)])).toDF("row", "first")


def found_repeats(rows: DataFrame, listed: DataFrame, history: int = 1) -> DataFrame:
    """(source_index_a, source_index_b) of all rows b of batches after ``history`` that repeat a row a accepted first."""
    spark = rows.sparkSession
    numbers = [r[0] for r in rows.select("batch_no").distinct().orderBy(F.col("batch_no").asc_nulls_first()).collect()]
    index = RepeatIndex(spark, listed)
    for n in numbers:
        index.accept(rows.where(F.col("batch_no").eqNullSafe(F.lit(n))), str(n))
    index.close()
    later = rows.where(F.col("batch_no") > history).select(F.col("source_index").alias("source_index_b")).distinct()
    groups = index.groups().toDF("source_index_b", "source_index_a")
    return groups.where("source_index_a < source_index_b").join(later, "source_index_b", "left_semi").select("source_index_a", "source_index_b")
