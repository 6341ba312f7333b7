"""Ledger compaction: the latest stored version of each review.

The window is partitioned by the review key, so a hot app does not form a
hot group: the group is one review's versions. Filtering on ``row_number
= 1`` lets Catalyst plan a partial ``WindowGroupLimit`` before the shuffle,
which keeps only the local best row per key and per map task (a map-side
combine for the top-1).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import BROADCAST_BYTE_LIMIT, measured_bytes
from ..session import written

LEDGER_COLUMNS = [
    "appid",
    "recommendationid",
    "updated_at",
    "ingested_at",
    "load_id",
    "hash_payload",
    "cursor",
    "payload",
]


def latest_order() -> list:
    """Newest first: change time (stored update, else ingestion), then
    ingestion, then load id; the payload hash makes full ties deterministic."""
    return [
        F.coalesce(F.col("updated_at"), F.col("ingested_at")).desc_nulls_last(),
        F.col("ingested_at").desc_nulls_last(),
        F.col("load_id").desc_nulls_last(),
        F.col("hash_payload").desc_nulls_last(),
    ]


def ledger_scan(ledger: DataFrame) -> DataFrame:
    """Pass-through projection of the ledger's eight columns."""
    return ledger.select(*LEDGER_COLUMNS)


def compact_latest(ledger: DataFrame, key: tuple[str, ...] = ("appid", "recommendationid")) -> DataFrame:
    """Keep the newest row per ``key`` (default: per app and review)."""
    w = Window.partitionBy(*key).orderBy(*latest_order())
    return (
        ledger.select(*LEDGER_COLUMNS)
        .withColumn("_row_num", F.row_number().over(w))
        .filter(F.col("_row_num") == 1)
        .drop("_row_num")
    )


def packed(text):
    """The bytes that a hex text spells, at half its length; null for other texts."""
    return F.when(F.lower(F.hex(F.unhex(text))) == text, F.unhex(text))


def compact_columns(rows: DataFrame, columns: list[str], key: tuple[str, ...] = ("appid", "recommendationid")) -> DataFrame:
    """``columns`` of the rows that ``compact_latest`` keeps, where a few columns are wanted.

    ``rows`` are ledger rows with whatever was derived from them before, row by
    row. Only the key, the order columns and ``columns`` are shuffled: no payload,
    and the hash as the bytes that it spells. The order is by the texts.
    """
    others = [c for c in dict.fromkeys([*key, "updated_at", "ingested_at", "load_id", *columns]) if c != "hash_payload"]
    spelled = packed(F.col("hash_payload"))
    moved = rows.select(
        *others, spelled.alias("_packed"), F.when(spelled.isNull(), F.col("hash_payload")).alias("_text")
    ).repartition(*key)
    whole = moved.withColumn("hash_payload", F.coalesce(F.lower(F.hex("_packed")), F.col("_text")))
    # a 64-bit hash in front settles nearly every comparison of the sort
    by_age = Window.partitionBy("_hash", *key).orderBy(*latest_order())
    ranked = whole.withColumn("_hash", F.xxhash64(*key)).withColumn("_row_num", F.row_number().over(by_age))
    return ranked.filter(F.col("_row_num") == 1).select(*columns)


_FILE, _ROW, _BLOCK = "_file", "_row", "_block"
_BLOCK_ROWS = 32768  # the rows of one bitmap of Spark's


def _located(ledger: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a ledger read from Parquet files, and where each row lies: a 64-bit hash of the file's path, and the row index."""
    path = F.xxhash64(F.col("_metadata.file_path"))
    return ledger.select(*columns, path.alias(_FILE), F.col("_metadata.row_index").alias(_ROW))


def _bitmaps(locators: DataFrame) -> DataFrame:
    """(file, block, bits): a bit per row of each block of a file, set for the rows that ``locators`` names."""
    blocks = locators.select(_FILE, F.expr(f"{_ROW} div {_BLOCK_ROWS}").alias(_BLOCK), (F.col(_ROW) % _BLOCK_ROWS).alias("_bit"))
    return blocks.repartition(_FILE, _BLOCK).groupBy(_FILE, _BLOCK).agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def _with_bits(rows: DataFrame, bitmaps: DataFrame, how: str) -> DataFrame:
    """The located ``rows`` whose bit is set in ``bitmaps``, which are broadcast (left_semi), or the others (left_anti)."""
    held = rows.withColumn(_BLOCK, F.expr(f"{_ROW} div {_BLOCK_ROWS}")).join(F.broadcast(bitmaps), [_FILE, _BLOCK], "left")
    octet = F.conv(F.hex(F.expr(f"substring(_bits, cast({_ROW} % {_BLOCK_ROWS} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    named = F.coalesce(F.getbit(octet, (F.col(_ROW) % 8).cast("int")) == 1, F.lit(False))
    return held.filter(named if how == "left_semi" else ~named).drop(_BLOCK, "_bits")


def _with_rows(rows: DataFrame, locators: DataFrame, how: str, byte_limit: int) -> DataFrame:
    """The located ``rows`` that ``locators`` (a written table) names, ``how`` being left_semi, or the others, left_anti.

    Locators are broadcast while they measure up to ``byte_limit``, beyond it as
    bitmaps, which take an eighth of a byte a row at most; ``rows`` are not moved then.
    Beyond that too, both meet in a shuffled hash join, unsorted.
    """
    if measured_bytes(locators) <= byte_limit:
        return rows.join(F.broadcast(locators), [_FILE, _ROW], how)
    if byte_limit > 0:
        bitmaps = written(_bitmaps(locators), "bitmaps")
        if measured_bytes(bitmaps) <= byte_limit:
            return _with_bits(rows, bitmaps, how)
    return rows.join(locators.hint("shuffle_hash"), [_FILE, _ROW], how)


def _superseded(ledger: DataFrame, key: tuple[str, ...], byte_limit: int) -> DataFrame:
    """Locators of the rows that ``compact_latest`` leaves out, as a written table."""
    spelled = packed(F.col("hash_payload"))
    hashed = "hash_payload" in key  # the hash then takes part as bytes, and settles no tie
    by = [c for c in key if c != "hash_payload"] + (["_packed", "_text"] if hashed else [])
    rows = ledger
    if hashed:
        rows = rows.withColumn("_packed", spelled).withColumn("_text", F.when(spelled.isNull(), F.col("hash_payload")))
    narrow = _located(rows, list(dict.fromkeys([*by, "updated_at", "ingested_at", "load_id"]))).repartition(*by)
    narrow = narrow.withColumn("_hash", F.xxhash64(*by))
    by_age = Window.partitionBy("_hash", *by).orderBy(*latest_order()[:-1])
    if hashed:
        by_age = Window.partitionBy("_hash", *by).orderBy(*latest_order()[:-1], F.col(_FILE), F.col(_ROW))
        place = F.row_number().over(by_age)
        return written(narrow.withColumn("_place", place).filter("_place > 1").select(_FILE, _ROW), "locators")
    # Ranks leave ties of everything but the hash. Only these rows' hashes are read.
    newest = F.sum(F.when(F.col("_place") == 1, 1)).over(Window.partitionBy("_hash", *by))
    ranked = narrow.withColumn("_place", F.rank().over(by_age)).withColumn("_newest", newest)
    ranked = ranked.filter("_place > 1 or _newest > 1").select(_FILE, _ROW, (F.col("_place") == 1).alias("_tied"))
    ranked = written(ranked, "locators")
    older, tied = ranked.filter("not _tied").select(_FILE, _ROW), ranked.filter("_tied").select(_FILE, _ROW)
    if tied.isEmpty():
        return older
    hashes = _with_rows(_located(ledger, [*key, "hash_payload"]), tied, "left_semi", byte_limit)
    # Full ties are equal in every column that the order names; the locator settles them.
    by_hash = Window.partitionBy(*key).orderBy(F.col("hash_payload").desc_nulls_last(), F.col(_FILE), F.col(_ROW))
    lost = hashes.withColumn("_place", F.row_number().over(by_hash)).filter("_place > 1").select(_FILE, _ROW)
    return older.unionByName(written(lost, "tied"))


def is_stored(df: DataFrame) -> bool:
    """Whether the rows of ``df`` come straight from files, so that they have locators."""
    try:
        return bool(df.select("_metadata.row_index").columns)
    except AnalysisException:
        return False


def merge_losers(existing: DataFrame | None, batch: DataFrame, key: tuple[str, ...], order: list[str]) -> DataFrame:
    """Locators of the rows that a merge of two stored tables leaves out, as a written table.

    Per key the newest row by ``order`` (its last column a hash) stays; on a tie
    of all of ``order`` the existing one. Rows with a null in the key meet no row
    of the other table; existing ones all stay.
    """
    *times, hashed = order
    spelled = packed(F.col(hashed))

    def narrow(df: DataFrame, new: bool) -> DataFrame:
        rows = df.withColumn("_packed", spelled).withColumn("_text", F.when(spelled.isNull(), F.col(hashed)))
        return _located(rows, [*key, *times, "_packed", "_text"]).withColumn("_new", F.lit(new))

    unnamed = F.greatest(*[F.col(k).isNull() for k in key]) if len(key) > 1 else F.col(key[0]).isNull()
    both = narrow(batch, True) if existing is None else narrow(existing, False).unionByName(narrow(batch, True))
    both = both.repartition(*key)
    both = both.withColumn("_hash", F.xxhash64(*key)).withColumn("_apart", F.when(unnamed, F.col("_new")))
    newest = [F.col(c).desc_nulls_last() for c in times] + [F.coalesce(F.lower(F.hex("_packed")), F.col("_text")).desc_nulls_last()]
    by_age = Window.partitionBy("_hash", *key, "_apart").orderBy(*newest, "_new", _FILE, _ROW)
    lost = both.withColumn("_place", F.row_number().over(by_age)).filter((F.col("_place") > 1) & F.coalesce(F.col("_apart"), F.lit(True)))
    return written(lost.select(_FILE, _ROW), "locators")


def merged_stored(
    existing: DataFrame | None, batch: DataFrame, losers: DataFrame, byte_limit: int = BROADCAST_BYTE_LIMIT
) -> DataFrame:
    """The rows of two stored tables but those that ``merge_losers`` names: a scan of both, nothing of which is shuffled."""
    columns = (batch if existing is None else existing).columns
    rows = _located(batch, columns)
    if existing is not None:
        rows = _located(existing, columns).unionByName(rows)
    return _with_rows(rows, losers, "left_anti", byte_limit).select(*columns)


def compact_derived(
    ledger: DataFrame,
    key: tuple[str, ...] = ("appid", "recommendationid"),
    byte_limit: int = BROADCAST_BYTE_LIMIT,
    whole: bool = False,
) -> DataFrame:
    """``compact_latest`` of rows that are no files yet, of which only those are written that may have another version.

    A first pass counts 64-bit hashes of the key, and no payload is derived
    for it. The hashes that occur again are set in bitmaps of up to
    ``byte_limit``, eight bits or more for each. A row whose bit is not set is its key's
    only one and is passed on as it is derived; the others, with a few that share a
    bit by chance, are written and compacted by row locators. With more
    hashes than half the bits all rows are written. ``ledger`` must derive the same
    rows each time, and costs a pass more than with ``whole``, by which all rows
    are written at once: more disk, less time.
    """
    rows = ledger.select(*LEDGER_COLUMNS)
    if whole:
        return compact_stored(written(rows, "ledger"), key, byte_limit)
    again = rows.groupBy(F.xxhash64(*key).alias("_hash")).count().filter("count > 1")
    again = written(again.select("_hash"), "again")
    found = again.count()
    if not found:
        return rows
    bits = min(max(8 * found, 64 * _BLOCK_ROWS), byte_limit * 8 * 63 // 64)  # the rest for the bitmaps' own keys
    if bits < 2 * found:
        return compact_stored(written(rows, "ledger"), key, byte_limit)

    def place(key_hash) -> list:
        return [F.lit(0).cast("long").alias(_FILE), F.pmod(key_hash, F.lit(bits).cast("long")).alias(_ROW)]

    bitmaps = written(_bitmaps(again.select(*place(F.col("_hash")))), "bitmaps")
    placed = rows.select("*", *place(F.xxhash64(*key)))
    several = written(_with_bits(placed, bitmaps, "left_semi").select(*LEDGER_COLUMNS), "ledger")
    single = _with_bits(placed, bitmaps, "left_anti").select(*LEDGER_COLUMNS)
    return single.unionByName(compact_stored(several, key, byte_limit))


def compact_stored(
    ledger: DataFrame,
    key: tuple[str, ...] = ("appid", "recommendationid"),
    byte_limit: int = BROADCAST_BYTE_LIMIT,
) -> DataFrame:
    """``compact_latest`` of a ledger that is read straight from Parquet files, with late materialization.

    The window sees only the key, the order's times and load, and a row locator
    (file and row index), so neither payload nor hash is shuffled or sorted to find
    the newest versions; hashes are read where everything else ties. The locators
    of superseded rows are written; a second scan leaves these rows out
    (``_with_rows``), and no payload moves.
    """
    rows = _located(ledger, LEDGER_COLUMNS)
    return _with_rows(rows, _superseded(ledger, key, byte_limit), "left_anti", byte_limit).select(*LEDGER_COLUMNS)


VERSION_KEY = ("appid", "recommendationid", "hash_payload")


def version_history(ledger: DataFrame) -> DataFrame:
    """Latest row per content version ``(appid, recommendationid, hash_payload)``,
    i.e. one row per distinct payload a review has had."""
    return compact_latest(ledger, VERSION_KEY)
