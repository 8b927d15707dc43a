"""End-to-end runs, each a chain of ``DataFrame -> DataFrame`` operators.

* ``daily_run`` — intake -> cap -> since -> validate -> prepare (exclude,
  categorise, label) -> fold -> upsert -> score -> merge -> publish.
* ``score_backlog`` — pending rows -> score -> merge.
* ``relabel`` — candidates -> score -> type-only merge -> outcome counts.

Nothing is collected to the driver; the only driver values are scalars
(counts, the store's max id). The prepared batch is used by the upsert and by
the counters, so it is checkpointed once (lineage cut, survives executor loss).
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


from .. import constants as K  # noqa: F401
from ..operators import rejects as RJ
from ..operators import report as R
from ..operators import scoring as SC
from ..operators import stats as STT
from ..operators import store as ST
from ..operators import taxonomy as TXN
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sources import intake as IN


@dataclass
class RunResult:
    """``rejected``: every row the run could not use (see operators/rejects)."""
    store: DataFrame
    stats: DataFrame
    rejected: DataFrame
    answers: DataFrame | None
    board_of: tuple  # as_of, categories, labels
    folded: DataFrame
    ids: DataFrame   # (url, id) of the batch, which the answers go by

    def change(self, base: ST.Snapshot, run_ts: _dt.datetime) -> tuple:
        """What the run writes to a version of a store: the rows of the buckets
        that its batch touches, with the answers."""
        buckets = base.touched(self.folded)
        part = base.read(buckets)
        ids = ST.batch_ids(part, self.folded, max_id=base.max_id)
        new = ST.upsert(part, self.folded, run_ts, ids=ids)
        if self.answers is not None:   # another writer may have given new urls other ids
            new = SC.merge_scores(new, self.answers.join(self.ids, "id").drop("id").join(ids, "url"))
        return new, buckets

    @property
    def board(self) -> DataFrame:
        """The active board of the new store; ranked when it is asked for."""
        return R.active_board(self.store, *self.board_of)


@dataclass
class FileIntake:
    """``rejected``: what the sources could not use (documents, items, detail
    pages, whole sources), as rows of operators/rejects. Unpacks to (intake,
    failures)."""
    intake: DataFrame
    failures: DataFrame
    rejected: DataFrame

    def __iter__(self):
        return iter((self.intake, self.failures))


def daily_run(intake: DataFrame | FileIntake, tax: TXN.Taxonomy, store: DataFrame | ST.Snapshot, run_ts: _dt.datetime, as_of: _dt.date,
              categories: list, labels: dict, scorer_factory=None, cap: int | None = None,
              since: _dt.date | None = None, source_failures: int = 0, checkpoint: bool = True,
              sources=None, reuse_prepared: bool = True) -> RunResult:
    """``reuse_prepared``: the prepared batch feeds both the store and the run
    counters; checkpoint it once when both are materialised. What the sources
    of a ``FileIntake`` rejected is among the run's rejects and counters; then
    ``source_failures`` are only those that it doesn't know."""
    unread = None
    if isinstance(intake, FileIntake):
        intake, unread = intake.intake, intake.rejected
    spark = intake.sparkSession
    if unread is not None and checkpoint:
        ensure_checkpoint_dir(spark)
        unread = unread.checkpoint(eager=True)           # counted and written: the sources are read for it once
    batch = IN.since_filter(IN.cap(intake, cap), since)
    valid, rejected = IN.split_valid(batch, sources if sources is not None else IN.K.SOURCES)
    prepared = TXN.prepare(valid, tax)
    if checkpoint and reuse_prepared:
        ensure_checkpoint_dir(spark)
        prepared = prepared.checkpoint(eager=True)
    kept = prepared.filter(F.col("stage") == "kept").withColumn("tender_type", F.col("pre_label"))
    folded = ST.fold_batch(kept)
    if checkpoint:
        ensure_checkpoint_dir(spark)
        folded = folded.checkpoint(eager=True)           # batch-sized; read by ids, upsert, scorer
    base, buckets = store, None
    if isinstance(base, ST.Snapshot):
        buckets = base.touched(folded)
        store = base.read(buckets)
    ids = ST.batch_ids(store, folded, checkpoint, base.max_id if buckets is not None else None)
    new_store = ST.upsert(store, folded, run_ts, ids=ids)
    answers = None
    if scorer_factory is not None:
        # the rows this run touched are the folded batch itself, with their ids:
        # the scorer input never re-reads the store
        touched = folded.join(ids, "url").select("id", "title", "description")
        raw = SC.score_rows(touched, scorer_factory, key="id", ledger=new_ledger(spark) if checkpoint else None)
        if checkpoint:
            raw = raw.checkpoint(eager=True)      # the scorer is called exactly once per row
        answers = SC.validate_answers(raw)
        new_store = SC.merge_scores(new_store, answers)
    if buckets is not None:
        new_store = base.but(buckets, new_store)
    rejects = RJ.of_validation(rejected)
    # without a cap or a date every fetched record is prepared or rejected, and
    # the sources needn't be parsed again to count them
    whole = cap is None and since is None
    stats = STT.run_stats(prepared, answers, fetched_total=None if whole else intake, cap=cap,
                          source_failures=source_failures, skip_ai=scorer_factory is None, rejected=rejects, source_rejected=unread)
    if unread is not None:
        rejects = RJ.union([unread, rejects])
    if answers is not None:
        rejects = RJ.union([rejects, RJ.of_answers(answers)])
    return RunResult(new_store, stats, rejects, answers, (as_of, categories, labels), folded, ids)


def scored_once(rows: DataFrame, scorer_factory) -> DataFrame:
    """Valid and invalid answers to ``rows``; the scorer is called once a row,
    however often the answers are read."""
    ensure_checkpoint_dir(rows.sparkSession)
    asked = SC.score_rows(rows, scorer_factory, key="id", ledger=new_ledger(rows.sparkSession))
    return SC.validate_answers(asked).checkpoint(eager=True)


def new_ledger(spark) -> str:
    """A folder for the scorer's answers of one run."""
    return scratch_dir(spark, f"answers-{uuid.uuid4().hex}")


def score_backlog(store: DataFrame, scorer_factory, limit: int | None = 100) -> tuple:
    """The store with scores of its pending rows, and the answers."""
    answers = scored_once(SC.pending(store, limit), scorer_factory)
    return SC.merge_scores(store, answers), answers


def relabel(store: DataFrame, as_of: _dt.date, scorer_factory, limit: int | None = None) -> tuple:
    """The store with new types of its open rows, and the answers."""
    answers = scored_once(SC.relabel_candidates(store, as_of, limit), scorer_factory)
    return SC.merge_scores(store, answers, type_only=True), answers


def publish_answers(spark, store_root: str, rows: DataFrame, scorer_factory, type_only: bool = False) -> tuple:
    """Ask for ``rows`` of the latest version and publish the next one, in which
    only the buckets of these rows are written. Returns the answers and whether
    there was anything to write."""
    ensure_checkpoint_dir(spark)
    rows = rows.select("id", "url", "title", "description").checkpoint(eager=True)
    answers = scored_once(rows.select("id", "title", "description"), scorer_factory)

    def change(base: ST.Snapshot) -> tuple | None:
        buckets = base.touched(rows)
        return (SC.merge_scores(base.read(buckets), answers, type_only=type_only), buckets) if buckets and not rows.isEmpty() else None

    before = ST.latest(spark, store_root).version
    return answers, ST.apply_touched(spark, store_root, change).version != before


def _ord(rank: int, key: str):
    """Input order across sources: (source rank, file key, position in file)."""
    return F.struct(F.lit(rank).alias("source_rank"), F.col(key).cast("string").alias("key"),
                    F.col("pos").cast("long").alias("pos"))


def intake_from_files(spark, listing_pages: str | DataFrame | None = None, listing_href_pattern: str | None = None,
                      listing_url_template: str | None = None, detail_pages: str | DataFrame | None = None,
                      feeds: str | DataFrame | None = None, feed_hosts=(), api_bodies: str | DataFrame | None = None,
                      api_url_prefix: str = "", api_hosts=(), container_pages: str | DataFrame | None = None,
                      container_selectors: str = "", url_of=None, sequence=None) -> FileIntake:
    """Build one intake batch from crawled files (the four source kinds), in
    fixed source order. Each source is parsed once, into a written frame of what
    it holds and what can't be used, before anything else: one that fails, while
    it is read too, is a failure of its own and the others go on.

    Sources are folders of files or tables (path, body).

    ``url_of(path_col) -> Column`` maps a file path to the page URL (default:
    the path); ``sequence(path_col) -> Column`` gives the order of files within a
    source as text (default: by path). Detail pages join the listing on URL; listing titles win.
    ``ord`` is ``(source_rank, file key, pos)``. Rejected are files without
    content and what is no feed, no JSON or can't be parsed; feed entries, API
    items and listing rows that the rules of their source leave out; listed
    links without a good detail page; sources that can't be loaded. Anchors
    that are no listing rows are no items, nor is a link met again.
    """
    from ..functions import dates as D
    from ..functions import urls as U
    from ..operators.ordering import keep_first
    from ..sources import feeds as FD
    from ..sources import files as FL
    from ..sources import html as H
    url_of = url_of or (lambda c: c)

    def pages(path):
        d = FL.with_key(FL.read_documents(spark, path), sequence)
        return d.select(F.col("doc_key").alias("page_id"), url_of(F.col("path")).alias("url"), F.col("body").alias("html"))

    def unread(source, path, status=None):
        """Files without content, and documents with an error."""
        empty = FL.with_key(FL.empty_documents(spark, path), sequence).withColumn("error", F.lit("empty document"))
        out = [RJ.of_documents(empty, source, "doc_key")]
        return out if status is None else [*out, RJ.of_documents(status, source, "doc_key")]

    def once(parsed: DataFrame) -> DataFrame:
        """Parsed now, whatever is read of it later."""
        ensure_checkpoint_dir(spark)
        return parsed.checkpoint(eager=True)

    loaders, rejected = [], []
    if listing_pages is not None:
        def detail_source():
            listing = H.link_listing(pages(listing_pages), listing_href_pattern, listing_url_template)
            listing = once(listing.select(F.col("link").alias("url"), "title", "page_id", "pos"))
            lost = unread("jst", listing_pages)
            det = pages(detail_pages) if detail_pages is not None else None
            if det is None:
                j = listing.select("*", F.lit(None).cast("date").alias("posted_date"),
                                   F.lit(None).cast("date").alias("deadline"))
            else:
                read = once(H.definition_fields(H.definition_pairs(det, keep=("url", "page_id")), ["url", "page_id"]))
                fields = H.first_good_page(read)
                empty = FL.empty_documents(spark, detail_pages).select(url_of(F.col("path")).alias("url"), F.lit("empty document").alias("error"))
                lost.append(RJ.of_details(listing, fields, H.bad_pages(read).union(empty), "jst"))
                fields = fields.select("url", D.era_date("first_value").alias("posted_date"),
                                       D.era_date("last_value").alias("deadline"))
                j = listing.join(fields, "url", "inner")
            rejected.extend(lost)
            return j.select(_ord(0, "page_id").alias("ord"),
                            F.lit("jst").alias("source"), U.last_path_segment("url").alias("external_id"),
                            "title", "url", F.lit(None).cast("string").alias("description"), "posted_date",
                            "deadline", F.lit("unknown").alias("tender_type"))
        loaders.append(("jst", detail_source))
    if feeds is not None:
        def feed_source():
            d = FL.with_key(FL.read_documents(spark, feeds), sequence)
            parsed = once(FD.feed_parse(d, "body", keep=("doc_key",)))
            e = FD.entries_of(parsed)
            f = FD.feed_items(e, feed_hosts, "mext", keep=("doc_key",))
            rejected.extend(unread("mext", feeds, FD.status_of(parsed, ("doc_key",))))
            rejected.append(RJ.of_items(FD.feed_item_errors(e, feed_hosts, keep=("doc_key",)), "mext", "doc_key"))
            return f.select(_ord(1, "doc_key").alias("ord"), "source",
                            "external_id", "title", "url", "description", "posted_date", "deadline",
                            F.lit("unknown").alias("tender_type"))
        loaders.append(("mext", feed_source))
    if container_pages is not None:
        def container_source():
            every = once(H.container_rows(pages(container_pages), container_selectors))
            bad = every.filter(~F.col("ok")).select(F.col("page_id").alias("doc_key"), F.lit("page could not be parsed").alias("error"))
            rejected.extend(unread("nedo", container_pages, bad))
            ev = every.filter(F.col("kind").isNotNull()).filter(H.fallback_anchor_filter())
            link = U.resolve(F.col("href"), F.col("url"))
            dates = D.row_dates(F.col("row_text"))
            ev = ev.select("page_id", "pos", "kind", "url", link.alias("link"), "title",
                           F.when(F.col("kind") == "row", D.row_date_value(F.get(dates, 0))).alias("posted_date"),
                           F.when(F.col("kind") == "row", D.row_date_value(F.get(dates, 1))).alias("deadline"))
            used = F.coalesce(F.col("link").isNotNull() & (U.host("link") == U.host("url")) & (F.col("title") != ""), F.lit(False))
            error = F.when(F.coalesce(F.col("title"), F.lit("")) == "", "title").when(F.col("link").isNull(), "url").otherwise("url not allowed")
            lost = ev.filter(~used & (F.col("kind") == "row"))
            rejected.append(RJ.of_items(lost.select("page_id", "pos", error.alias("error")), "nedo", "page_id"))
            ev = ev.filter(used).drop("kind")
            ev = ev.withColumn("ord", _ord(2, "page_id"))
            first = keep_first(ev.drop("url"), "link", "ord")
            return first.select("ord", F.lit("nedo").alias("source"), F.lit(None).cast("string").alias("external_id"),
                                "title", F.col("link").alias("url"), F.lit(None).cast("string").alias("description"),
                                "posted_date", "deadline", F.lit("unknown").alias("tender_type"))
        loaders.append(("nedo", container_source))
    if api_bodies is not None:
        def api_source():
            d = FL.with_key(FL.read_documents(spark, api_bodies), sequence)
            parsed = once(FD.json_parse(d, "body", keep=("doc_key",)))
            e = FD.entries_of(parsed)
            j = FD.json_items(e, api_url_prefix, api_hosts, "jgrants", keep=("doc_key",))
            rejected.extend(unread("jgrants", api_bodies, FD.status_of(parsed, ("doc_key",))))
            rejected.append(RJ.of_items(FD.json_item_errors(e, api_url_prefix, api_hosts, keep=("doc_key",)), "jgrants", "doc_key"))
            return j.select(_ord(3, "doc_key").alias("ord"), "source",
                            "external_id", "title", "url", "description", "posted_date", "deadline",
                            F.lit("unknown").alias("tender_type"))
        loaders.append(("jgrants", api_source))
    union, failures = IN.union_sources(spark, loaders)
    return FileIntake(union.drop("source_rank"), failures, RJ.union([RJ.of_failures(failures), *rejected]))


def run_and_publish(spark, intake: DataFrame | FileIntake, tax, store_root: str, out_dir: str, run_ts, as_of,
                    categories: list, labels: dict, scorer_factory=None, cap=None, since=None,
                    source_failures: int = 0, sources=None, buckets: int = ST.BUCKETS) -> dict:
    """Daily run against the latest store snapshot: writes the touched buckets
    as the next snapshot (a new store gets ``buckets``) and the rejected rows, publishes the board and the archive from what it
    wrote, and returns the counters."""
    res = daily_run(intake, tax, ST.latest(spark, store_root, buckets=buckets), run_ts, as_of, categories, labels, scorer_factory, cap,
                    since, source_failures, sources=sources)
    ST.apply_touched(spark, store_root, lambda base: res.change(base, run_ts), buckets=buckets)
    done = published(spark, store_root, out_dir, run_ts, as_of, categories, labels)
    done["rejects"] = os.path.join(out_dir, "rejects")
    res.rejected.write.mode("overwrite").parquet(done["rejects"])
    return {**done, "stats": res.stats.first().asDict()}


def published(spark, store_root: str, out_dir: str, run_ts, as_of, categories: list, labels: dict) -> dict:
    """Publish from the snapshot that was written last."""
    done = publish_only(spark, store_root, out_dir, run_ts, as_of, categories, labels)
    return {"snapshot": os.path.join(store_root, f"v={done['version']}"), **done}


def publish_only(spark, store_root: str, out_dir: str, run_ts, as_of, categories: list, labels: dict,
                 version: int | None = None) -> dict:
    """Publish the board and the archive of a snapshot, the latest by default."""
    written = ST.read_store(spark, store_root, version)
    board = R.active_board(written, as_of, categories, labels)
    versions = ST.snapshot_versions(spark, store_root)
    return {"version": version if version is not None else (versions[-1] if versions else None),
            **R.publish(board, R.archive(written, run_ts), out_dir)}


def backlog_run(spark, store_root: str, out_dir: str, run_ts, as_of, categories: list, labels: dict, scorer_factory,
                limit: int | None = 100) -> dict:
    """Score pending rows of the latest snapshot, write the next one, publish,
    and return the counts and the exit status."""
    answers, wrote = publish_answers(spark, store_root, SC.pending(ST.read_store(spark, store_root), limit), scorer_factory)
    done = published(spark, store_root, out_dir, run_ts, as_of, categories, labels) if wrote else {}
    return {**done, **answer_counts(answers)}


def relabel_run(spark, store_root: str, out_dir: str, run_ts, as_of, categories: list, labels: dict, scorer_factory,
                limit: int | None = None, dry_run: bool = False) -> dict:
    """Ask for the types of open rows without a confirmed one. A dry run only
    counts the candidates: nothing is asked or written."""
    store = ST.read_store(spark, store_root)
    if dry_run:
        return {"candidates": SC.relabel_candidates(store, as_of, limit).count(), "exit_status": 0}
    answers, wrote = publish_answers(spark, store_root, SC.relabel_candidates(store, as_of, limit), scorer_factory, type_only=True)
    outcomes = {r["outcome"]: r["n"] for r in SC.relabel_outcomes(answers).collect()}  # a row a type
    done = published(spark, store_root, out_dir, run_ts, as_of, categories, labels) if wrote else {}
    return {**done, **answer_counts(answers), "outcomes": outcomes}


def answer_counts(answers: DataFrame) -> dict:
    r = answers.agg(F.count(F.lit(1)).alias("asked"), F.count_if("ok").alias("scored"), F.count_if(~F.col("ok")).alias("failed")).first()
    return {**r.asDict(), "exit_status": int(r["failed"] > 0)}
