"""A replay-safe parquet store for the hotels / reviews / reviewers tables, rejects and counters.

Layout under ``root`` (a shared folder, e.g. below spark.checkpoint.dir):
  data/<seq>-<attempt>/hotels     full snapshot (hotels are few next to reviews)
  data/<seq>-<attempt>/reviews    the reviews this load inserted (insert-ignore appends
                                  only) with their reviewers, sorted by key within files,
                                  so a lookup's pushed filter skips pages; a compaction
                                  holds those of all loads
  data/<seq>-<attempt>/rejects    file, line_no, stage, errors, raw, job_id
  data/<seq>-<attempt>/counters   per job and file: records, hotels upserted, reviews inserted
  commits/<seq>                   one line: writer, batch id, folder, kind, tables (journal.Journal)

The store owns the sequence: a load is named by (writer, batch id), for instance a
stream's checkpoint and its micro-batch, and gets the next free sequence number. Its
tables become visible together, when its commit is published. Of two loads that ran at
once the second is merged again, into what the first one left. A load whose (writer,
batch id) is committed already is not applied twice. Folders without a commit are
leftovers of a crash; nothing reads them, and a torn commit stops no later load.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import ordinal, records, store
from .journal import Journal, Taken

HOTEL_SCHEMA = ("hotel_id int, platform string, hotel_name string, overall_score decimal(3,1), "
                "review_count int, grades string, created_at timestamp_ntz, updated_at timestamp_ntz")
REVIEW_SCHEMA = ("hotel_review_id int, hotel_id int, reviewer_id int, platform string, rating decimal(3,1), "
                 "rating_text string, review_title string, review_comments string, review_positives string, "
                 "review_negatives string, review_date timestamp_ntz, check_in_date_month_and_year string, "
                 "is_show_review_response boolean, responder_name string, response_date_text string, "
                 "translate_source string, translate_target string, encrypted_review_data string, "
                 "provider_id int, review_provider_text string, processing_job_id string, "
                 "created_at timestamp_ntz, updated_at timestamp_ntz")
REVIEWER_STRUCT = "reviewer struct<" + ", ".join(f"{k}: {t}" for k, t in records.REVIEWER_FIELDS.items()) + ">"
REJECT_SCHEMA = "file string, line_no bigint, stage string, errors array<string>, raw string, job_id string"
COUNTER_SCHEMA = ("file string, job_id string, total_records bigint, valid_records bigint, invalid_records bigint, "
                  "hotels_upserted bigint, reviews_inserted bigint")
COMPACTED = "compacted"
LOAD_TABLES = ("hotels", "reviews", "rejects", "counters")
ATTEMPTS = 20
KEY_RANGES = 64
STAGED_CODEC = "zstd"   # the staged rows and the reviews are most of what a load keeps on disk


@dataclass(frozen=True)
class Commit:
    seq: int
    writer: str
    batch: str
    folder: str
    kind: str
    tables: tuple[str, ...]


class ConcurrentLoad(RuntimeError):
    """Other loads were committed between every attempt's read and its commit."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.journal = Journal(spark, f"{self.root}/commits")

    def commits(self) -> list[Commit]:
        """All commits in order."""
        return _commits(self.journal.read()[0])

    def committed(self, writer: str, batch) -> Commit | None:
        return next((c for c in self.commits() if (c.writer, c.batch) == (writer, str(batch))), None)

    def _attempt(self, write, writer: str, batch, kind: str = "load") -> Commit:
        """``write(commits so far, folder)`` merges into the store of the moment and gives the names of the tables it
        wrote (none: nothing to commit); done again if another load was committed meanwhile."""
        for _ in range(ATTEMPTS):
            known, seq = self.journal.read()
            folder = f"data/{seq:010d}-{uuid.uuid4().hex[:8]}"
            tables = write(_commits(known), f"{self.root}/{folder}")
            if not tables:
                return None
            try:
                self.journal.publish(seq, writer, str(batch), folder, kind, ",".join(tables))
            except Taken:
                if done := self.committed(writer, batch):
                    return done
                continue
            return Commit(seq, writer, str(batch), folder, kind, tuple(tables))
        raise ConcurrentLoad(f"{self.root}: load {batch} of {writer} met {ATTEMPTS} others")

    # -- reads: committed loads only --
    def _folders(self, table: str, schema: str, since_compaction: bool = True, commits: list[Commit] | None = None) -> DataFrame:
        paths, empty = [], self.spark.createDataFrame([], schema)
        for c in self.commits() if commits is None else commits:
            if since_compaction and c.kind == COMPACTED:
                paths = []
            if table in c.tables:
                paths.append(f"{self.root}/{c.folder}/{table}")
        return self.spark.read.schema(empty.schema).parquet(*paths) if paths else empty

    def hotels(self, commits: list[Commit] | None = None) -> DataFrame:
        """The latest hotels snapshot."""
        for c in reversed(self.commits() if commits is None else commits):
            if "hotels" in c.tables:
                return self.spark.read.parquet(f"{self.root}/{c.folder}/hotels")
        return self.spark.createDataFrame([], HOTEL_SCHEMA)

    def reviews(self, commits: list[Commit] | None = None) -> DataFrame:
        return self._folders("reviews", REVIEW_SCHEMA, commits=commits)

    def reviewers(self) -> DataFrame:
        """One row for each stored review whose record named its reviewer."""
        rows = self._folders("reviews", f"hotel_review_id int, {REVIEWER_STRUCT}")
        return rows.filter("reviewer IS NOT NULL").select("hotel_review_id", "reviewer.*")

    def rejects(self) -> DataFrame:
        return self._folders("rejects", REJECT_SCHEMA, since_compaction=False)

    def counters(self, writer: str | None = None, batch=None) -> DataFrame:
        """Counters of all loads, or of the load (writer, batch) alone: then one folder is read."""
        if writer is not None:
            c = self.committed(writer, batch)
            return (self.spark.read.parquet(f"{self.root}/{c.folder}/counters") if c
                    else self.spark.createDataFrame([], COUNTER_SCHEMA))
        return self._folders("counters", COUNTER_SCHEMA, since_compaction=False)

    # -- one load --
    def stage(self, checked: DataFrame, job_id: Column) -> DataFrame:
        """Checked lines as the slim frame a load is made from (typed columns, no VARIANT but the reviewer's)."""
        # The record's columns are dropped as soon as both projections have read them.
        lines = ["file", "ord", "value", "_source", "_physical", "_split", "_mid", "errors", "is_valid", "r_reviewerInfo"]
        lines = [c for c in lines if c in checked.columns]
        named = checked.withColumn("_job", job_id).select(*dict.fromkeys([*lines, "_job", *store.HOTEL_INPUTS, *store.REVIEW_INPUTS]))
        hotels = store.hotel_rows(named, keep_all=True, keep=list(dict.fromkeys([*lines, "_job", *store.REVIEW_INPUTS])))
        rows = store.review_rows(hotels, F.col("_job"), keep_all=True, keep=[
            *lines, "_hotel_row", "hotel_errors", *["h_" + c for c in store.HOTEL_COLUMNS]])
        has = lambda c, otherwise: F.col(c) if c in checked.columns else otherwise
        rv = F.col("r_reviewerInfo")
        reviewer = F.when(rv.isNotNull() & ~F.is_variant_null(rv), F.struct(
            *[F.try_variant_get(rv, f"$.{k}", t).alias(k) for k, t in records.REVIEWER_FIELDS.items()]))
        return rows.select(
            "file", "ord", has("_source", F.col("file")).alias("_source"), has("_physical", F.col("file")).alias("_physical"),
            has("_split", F.lit(0)).cast("bigint").alias("_split"), has("_mid", F.lit(None)).cast("bigint").alias("_mid"),
            F.when(~F.col("is_valid") | (F.size("storage_errors") > 0) | (F.size("hotel_errors") > 0), F.col("value")).alias("raw"),
            "errors", "is_valid", "_hotel_row", "hotel_errors",
            *["h_" + c for c in store.HOTEL_COLUMNS], "_review_row", "storage_errors", *store.REVIEW_COLUMNS,
            reviewer.alias("reviewer"))

    def apply(self, checked: DataFrame, writer: str, batch, job_id: Column, run_ts: Column, metrics: dict | None = None) -> Commit:
        """Merges one load of checked lines; what is committed as (writer, batch) already stays as it is.

        ``metrics`` gets the load's counters, observed while its rows are written.
        """
        if done := self.committed(writer, batch):
            return done
        staged = f"{self.root}/data/staged-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        self.stage(checked, job_id).observe(
            seen, F.count(F.lit(1)).alias("total_records"), F.count_if("is_valid").alias("valid_records"),
            F.count_if(~F.col("is_valid")).alias("invalid_records"),
            F.count_if(F.col("is_valid") & _hotel_ok()).alias("hotels_upserted")).write.parquet(staged, compression=STAGED_CODEC)
        if metrics is not None:
            metrics.update(seen.get)
        commit = self.apply_staged(self.spark.read.parquet(staged), writer, batch, run_ts, metrics)
        self.drop(staged)
        return commit

    def drop(self, *staged: str) -> None:
        """Deletes staged rows, once they are committed: nothing reads them any more."""
        for path in staged:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def apply_staged(self, slim: DataFrame, writer: str, batch, run_ts: Column, metrics: dict | None = None) -> Commit:
        """Merges one load of staged rows (``stage``'s columns, stored: they are read several times)."""
        if done := self.committed(writer, batch):
            return done
        valid = slim.filter("is_valid")
        hotel_ok = _hotel_ok()
        hotel_rows = valid.filter(hotel_ok).select(
            "file", "ord", *[F.col("h_" + c).alias(c) for c in store.HOTEL_COLUMNS],
            F.col("hotel_errors").alias("storage_errors"))
        # The first storable row of a key wins (as in store.first_reviews), if the key is not stored yet.
        review_rows = valid.filter(F.col("_review_row") & (F.size("storage_errors") == 0))
        first = review_rows.groupBy("hotel_review_id").agg(F.min("ord").alias("ord"))
        ranges = store.key_ranges(review_rows, "hotel_review_id", KEY_RANGES)

        def write(commits: list[Commit], out: str) -> tuple[str, ...]:
            store.merge_hotels(self.hotels(commits), store.fold_hotels(hotel_rows), run_ts).write.parquet(f"{out}/hotels")
            keys = self.reviews(commits).select("hotel_review_id").where(store.within(ranges, "hotel_review_id"))
            new_keys = first.join(keys, "hotel_review_id", "left_anti")
            new = review_rows.join(new_keys.select(F.col("hotel_review_id").alias("_key"), F.col("ord").alias("_ord")),
                                   (F.col("hotel_review_id") == F.col("_key")) & (F.col("ord") == F.col("_ord")), "left_semi")
            seen = Observation()
            new.select(*store.REVIEW_COLUMNS, run_ts.alias("created_at"), run_ts.alias("updated_at"), "reviewer", "file").observe(
                seen, F.count(F.lit(1)).alias("reviews_inserted")).sortWithinPartitions("hotel_review_id").write.parquet(f"{out}/reviews", compression=STAGED_CODEC)
            if metrics is not None:
                metrics.update(seen.get)
            inserted = self.spark.read.parquet(f"{out}/reviews")

            self._rejects(slim).write.parquet(f"{out}/rejects")
            totals = slim.groupBy("file", F.col("processing_job_id").alias("job_id")).agg(
                F.count(F.lit(1)).alias("total_records"), F.count_if("is_valid").alias("valid_records"),
                F.count_if(~F.col("is_valid")).alias("invalid_records"),
                F.count_if(F.col("is_valid") & hotel_ok).alias("hotels_upserted"))
            per_file = inserted.groupBy(F.col("file").alias("_f"), F.col("processing_job_id").alias("_j")).agg(
                F.count(F.lit(1)).alias("_n"))
            totals.join(per_file, F.col("file").eqNullSafe(F.col("_f")) & F.col("job_id").eqNullSafe(F.col("_j")), "left").select(
                "file", "job_id", "total_records", "valid_records", "invalid_records", "hotels_upserted",
                F.coalesce("_n", F.lit(0)).alias("reviews_inserted")).write.parquet(f"{out}/counters")
            return LOAD_TABLES

        return self._attempt(write, writer, batch)

    def _rejects(self, slim: DataFrame) -> DataFrame:
        """Lines that failed a rule (stage record) or a storage constraint (stage hotel / review)."""
        bad = slim.select(
            F.col("_physical").alias("file"), "_source", "_split", "_mid", "raw", F.col("processing_job_id").alias("job_id"),
            F.explode(F.filter(F.array(
                F.when(~F.col("is_valid"), F.struct(F.lit("record").alias("stage"), "errors")),
                F.when(F.col("is_valid") & F.col("_hotel_row") & (F.size("hotel_errors") > 0),
                       F.struct(F.lit("hotel").alias("stage"), F.col("hotel_errors").alias("errors"))),
                F.when(F.col("is_valid") & F.col("_review_row") & (F.size("storage_errors") > 0),
                       F.struct(F.lit("review").alias("stage"), F.col("storage_errors").alias("errors")))),
                lambda x: x.isNotNull())).alias("_r"))
        numbered = ordinal.number_by_splits(slim.select("_source", "_split", "_mid"), "_source", keep=bad)
        return numbered.select("file", F.col("line_no").cast("bigint").alias("line_no"), "_r.stage", "_r.errors", "raw", "job_id")

    # -- maintenance --
    def compact(self) -> Commit | None:
        """Rewrites all reviews into one folder of key ranges. Readers go on meanwhile."""

        def write(commits: list[Commit], out: str) -> tuple[str, ...]:
            if not commits:
                return ()
            rows = self._folders("reviews", f"{REVIEW_SCHEMA}, {REVIEWER_STRUCT}", commits=commits)
            rows.repartitionByRange("hotel_review_id").sortWithinPartitions("hotel_review_id").write.parquet(f"{out}/reviews")
            return ("reviews",)

        return self._attempt(write, "store", f"compaction-{uuid.uuid4().hex}", COMPACTED)

    # -- single-row operations (the service's per-record repository calls) --
    def upsert_hotel(self, hotel: dict, run_ts: Column) -> None:
        """Inserts one hotel (review_count 0 unless given) or updates the given fields of a stored one.

        platform and created_at stay as first stored.
        """
        given = [c for c in store.HOTEL_COLUMNS if c in hotel and c not in ("hotel_id", "platform")]
        schema = ", ".join(x for x in HOTEL_SCHEMA.split(", ") if not x.startswith(("created_at", "updated_at")))
        row = {c: hotel.get(c) for c in store.HOTEL_COLUMNS}
        one = self.spark.createDataFrame([tuple(row.values())], schema)

        def write(commits: list[Commit], out: str) -> tuple[str, ...]:
            old = self.hotels(commits).filter(F.col("hotel_id") == F.lit(hotel["hotel_id"]))
            kept = one.alias("n").join(old.alias("o"), "hotel_id", "left")
            merged = kept.select("hotel_id", "n.platform", *[
                (F.col(f"n.{c}") if c in given else F.when(F.col("o.created_at").isNotNull(), F.col(f"o.{c}")).otherwise(
                    F.lit(0) if c == "review_count" else F.lit(None))).alias(c)
                for c in store.HOTEL_COLUMNS if c not in ("hotel_id", "platform")])
            store.merge_hotels(self.hotels(commits), merged, run_ts).write.parquet(f"{out}/hotels")
            return ("hotels",)

        self._attempt(write, "single", uuid.uuid4().hex)

    def create_review(self, review: dict, run_ts: Column) -> DataFrame:
        """The stored review with this key; ``review`` is inserted first if there is none.

        The key is looked up in the store that the insert is committed to: of two callers one inserts.
        """
        key = review["hotel_review_id"]
        schema = ", ".join(x for x in REVIEW_SCHEMA.split(", ") if not x.startswith(("created_at", "updated_at")))

        def write(commits: list[Commit], out: str) -> tuple[str, ...]:
            if not self.reviews(commits).filter(F.col("hotel_review_id") == F.lit(key)).isEmpty():
                return ()
            df = self.spark.createDataFrame([tuple(review.get(c) for c in store.REVIEW_COLUMNS)], schema)
            df.select(*store.REVIEW_COLUMNS, run_ts.alias("created_at"), run_ts.alias("updated_at")).write.parquet(f"{out}/reviews")
            return ("reviews",)

        self._attempt(write, "single", uuid.uuid4().hex)
        return self.reviews().filter(F.col("hotel_review_id") == F.lit(key)).limit(1)


def _commits(entries: dict[int, list[str]]) -> list[Commit]:
    return [Commit(n, *fields[:4], tuple(fields[4].split(","))) for n, fields in entries.items()]


def _hotel_ok() -> Column:
    return F.col("_hotel_row") & (F.size("hotel_errors") == 0)
