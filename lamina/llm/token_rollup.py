"""Token counts as delta-maintained rollups.

A batch of changes holds signed rows: an insert adds a document and its tokens, a delete takes them
away, a revision takes the old count away and adds the new one. A batch is summed to one row for each
(source, lang, tokenizer) before it is written, so what is kept grows with the number of keys and
batches and not with the documents.

Commits are idempotent and whole. A batch is written to a folder of its own; then a claim, an empty file that
names the folder, is made; then the batch's registration, a file with the folder's name that is written elsewhere and
renamed into place, which fails if there is one. The rename is the commit. A claim counts only if its batch is
registered with its folder, so a writer that is lost at any step before has done nothing, one that is lost after has
committed, a retry can't commit twice, and of two writers of one id one commits. (The file system must rename a file
at once and refuse a name that is taken, as HDFS does.)

compact() takes one listing, sums exactly the folders in it into a base, and makes that the next base by the same
rename, so a batch that is committed meanwhile stays a claim, and of two compactions one counts. A base's mark lists the
claims that it took up, which are then removed; older ones are gone already. So what is listed and read
is bounded by the batches since the last base. Registrations stay, in folders by hash, and are only looked up by name.
Readers look whether the base is still the same after listing, and list again if not. Totals are
the sums over base and claims, the same in whatever order batches came.

Null texts count as empty; null sources and languages are keys of their own. Very long texts are counted whole, in a
task's memory. Repeated rows are repeated changes and count each. Empty batches commit and add nothing. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import _common as C
from lamina.llm import bpe

KEYS = ("source", "lang", "tokenizer")
CHANGES = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "source", "lang"), text: str = "text") -> DataFrame:
    """The columns of `keep` and counts, a map from tokenizer version to number of tokens."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = docs.select(*keep, F.struct(*keep, words.cast("long").alias("__words")).alias("__row"), F.coalesce(F.col(text), F.lit("")).alias("__body"))
    encoded = bpe.encode(rows, "__body", ("__row",))
    return encoded.select(*(F.col(f"__row.{c}").alias(c) for c in keep), F.create_map(F.lit("words-v1"), F.col("__row.__words"), F.lit("byte-bpe-multi-50k"), F.size("ids").cast("long")).alias("counts"))


def changes(rows: DataFrame, sign: int, counted: str = "counts") -> DataFrame:
    """Signed rows for inserts (sign 1) or deletes (-1) of documents with source, lang and a map of counts."""
    return rows.select("source", "lang", F.explode(counted).alias("tokenizer", "n")).select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (sign * F.col("n")).alias("n_tokens"))


def revisions(rows: DataFrame, old: str, new: str) -> DataFrame:
    """Signed rows for documents that stay and whose counts change from one map to the other."""
    return changes(rows, -1, old).unionByName(changes(rows, 1, new))


class Rollup:
    """Committed batches in a directory that all executors share: data/ has folders; claims/, ids/ and bases/ small files."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory
        self.jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(directory).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(directory).toUri(), conf)
        for part in ("claims", "ids", "bases", "data", "made"):
            self.fs.mkdirs(self.path(f"{directory}/{part}"))

    def _at(self, *parts: str):
        return self.path("/".join((self.directory, *parts)))

    def _names(self, part: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self._at(part)))

    def _read(self, *parts: str) -> list[str] | None:
        """The lines of a small file, None if there is none."""
        try:
            stream = self.fs.open(self._at(*parts))
        except Py4JJavaError as error:
            if "NotFound" in error.java_exception.getClass().getName():
                return None
            raise
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode().splitlines()
        finally:
            stream.close()

    def _place(self, lines: list[str], *parts: str) -> bool:
        """Writes a small file elsewhere and renames it into place; False if that is taken."""
        made = self._at("made", uuid.uuid4().hex)
        out = self.fs.create(made, False)
        out.write("\n".join(lines).encode())
        out.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            self.fs.mkdirs(self._at(*parts[:-1]))
            self.context.rename(made, self._at(*parts), self.spark.sparkContext._gateway.new_array(rename, 0))
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self.fs.delete(made, False)
            return False
        return True

    def _write(self, rows: DataFrame, name: str) -> str:
        folder = f"{name}.{uuid.uuid4().hex}"
        rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.parquet(f"{self.directory}/data/{folder}")
        return folder

    def _registered(self, batch: str) -> str | None:
        found = self._read("ids", _shard(batch), batch)
        return found[0] if found else None

    def _claim(self, folder: str) -> None:
        self.fs.create(self._at("claims", folder), False).close()

    def _register(self, batch: str, folder: str) -> bool:
        return self._place([folder], "ids", _shard(batch), batch)

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Adds a batch; False if it was committed before, and then nothing changes."""
        if not re.fullmatch("[A-Za-z0-9_-]+", batch):
            raise ValueError(f"a batch id has letters from A to Z, digits, - and _: {batch!r}")
        if self._registered(batch):
            return False
        folder = self._write(rows, batch)
        self._claim(folder)
        done = self._register(batch, folder)
        if not done:
            self.fs.delete(self._at("claims", folder), False)
            self.fs.delete(self._at("data", folder), True)
        return done

    def committed(self, batch: str) -> bool:
        return self._registered(batch) is not None

    def _listing(self) -> tuple[int, str | None, list[str], list[str]]:
        """How many bases there are, the last one's folder, the claims it took up, and the folders committed since."""
        while True:
            bases = self._names("bases")
            base = self._read("bases", bases[-1]) if bases else []
            claims = [c for c in self._names("claims") if c not in set(base[1:])]
            since = [c for c in claims if self._registered(c.split(".")[0]) == c]
            if self._names("bases") == bases:
                return len(bases), (base or [None])[0], base[1:], since

    def _sum(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.schema(CHANGES).parquet(*(f"{self.directory}/data/{x}" for x in folders)) if folders else self.spark.createDataFrame([], CHANGES)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def _drop_claims(self, claims: list[str]) -> None:
        for claim in claims:
            self.fs.delete(self._at("claims", claim), False)

    def compact(self) -> bool:
        """Sums what is committed into one folder; False if another compaction came first. Folders that older bases or
        claims name stay, for readers that have begun; a compaction that is lost half-way changes nothing."""
        number, base, taken, since = self._listing()
        self._drop_claims(taken)  # a compaction that was lost may have left some
        folder = self._write(self._sum([base, *since] if base else since), "base")
        done = self._place([folder, *since], "bases", f"{number:09d}")
        if done:
            self._drop_claims(since)
        else:
            self.fs.delete(self._at("data", folder), True)
        return done

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; keys whose documents are all gone have none."""
        _, base, _, since = self._listing()
        return self._sum([base, *since] if base else since).where("n_docs <> 0 OR n_tokens <> 0")


def _shard(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()[:3]


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads every document, deletes those labelled of low quality, revises the counts of those
    labelled toxic to their lower-cased texts', and commits the deletes again, as a retry would."""
    scratch = C.Scratch(spark, "rollup")
    docs = C.table(spark, sf_dir, "documents")
    counted = scratch.save(counts(docs), "counts")
    labels = C.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    low = scratch.save(labels.where("quality = 0").select("doc_id"), "low")
    toxic = scratch.save(labels.where("toxic = 1 AND coalesce(quality, 1) <> 0").select("doc_id"), "toxic")
    lowered = scratch.save(counts(docs.join(C.small(toxic), "doc_id", "left_semi").withColumn("text", F.lower("text"))), "lowered")
    both = counted.join(lowered.select("doc_id", F.col("counts").alias("new")).dropDuplicates(["doc_id"]), "doc_id")
    rollup = Rollup(spark, scratch.path("rollup"))
    deleted = changes(counted.join(C.small(low), "doc_id", "left_semi"), -1)
    rollup.commit("1-load", changes(counted, 1))
    rollup.commit("2-quality", deleted)
    rollup.commit("3-revise", revisions(both, "counts", "new"))
    rollup.commit("2-quality", deleted)
    return rollup.totals()
