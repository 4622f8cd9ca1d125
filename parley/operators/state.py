"""Pipeline state: audits, change detection, queues, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# The codes of what can be wrong with a note's state, and the artifacts that a review leaves.
ISSUES = (
    "NOTE_MISSING", "NOTE_UNREADABLE", "NOTE_INVALID", "NOTE_REFERENCE_INVALID", "TRANSCRIPT_MISSING", "PREVIEW_MISSING", "PREVIEW_STALE", "REVIEW_MISSING", "REVIEW_INVALID",
    "READINESS_MISSING", "READINESS_INVALID", "READINESS_STALE", "QUEUE_ORPHAN_REF", "JOB_STAGED_NOTE", "JOB_STAGED_REVIEW", "JOB_ORPHAN_REF", "LEGACY_NOTE_UNTRACKED",
)
ARTIFACTS = ("review.md", "review.json", "wiki-update-candidates.md")
REPAIRABLE = ("PREVIEW_MISSING", "PREVIEW_STALE", "REVIEW_MISSING", "REVIEW_INVALID", "READINESS_MISSING", "READINESS_STALE", "JOB_STAGED_REVIEW")
READINESS = ("source_path", "source_sha256", "transcript_path", "transcript_sha256", "readable_path", "readable_sha256", "review_dir")


def receipt_shape(receipt: Column, artifacts: tuple[str, ...] = ARTIFACTS) -> Column:
    """whether a readiness receipt (a struct of RECEIPTS' kind) is of version 1, names all of READINESS and has a hash of each artifact, and of no other."""
    named = F.lit(True)
    for field in READINESS:
        named = named & (F.coalesce(receipt[field], F.lit("")) != "")
    found = receipt["review_artifacts"]
    same = F.array_sort(F.map_keys(found)) == F.array_sort(F.array(*map(F.lit, artifacts)))
    return F.coalesce((receipt["schema_version"] == 1) & named & same & ~F.exists(F.map_values(found), lambda v: F.coalesce(v, F.lit("")) == ""), F.lit(False))


def audit(notes: DataFrame, pending: DataFrame, jobs: DataFrame, published: DataFrame) -> DataFrame:
    """Every key of the notes, the queue and the jobs (stage: note or review) with its issue codes, sorted, the action that
    comes first, and whether its source is there. ``notes``: key, and booleans readable, valid (the contract), transcript (there and not
    blank), preview (there), preview_faithful, review (all artifacts there), review_valid, receipt (there), receipt_valid (its shape)
    and receipt_current (all its hashes); null counts as false. A key without such a row has no note; ``transcript`` may be given for it as well,
    with ``exists`` false. ``published`` are the keys known from before."""
    n = notes if "exists" in notes.columns else notes.withColumn("exists", F.lit(True))
    x = n.join(pending.select("key").distinct().withColumn("queued", F.lit(True)), "key", "full_outer")
    x = x.join(jobs.groupBy("key").agg(F.first("stage").alias("stage")), "key", "full_outer")
    x = x.join(published.select("key").distinct().withColumn("published", F.lit(True)), "key", "left")
    x = x.filter(F.coalesce("exists", F.lit(False)) | F.col("queued") | F.col("stage").isNotNull())
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    sound = F.col("key").rlike(r"^notes/[^/]+/[^/]+\.md$") & ~F.col("key").rlike(r"(?:^|/)\.\.?(?:/|$)")
    there, job = yes("exists") & sound, F.col("stage").isNotNull()
    open_ = there & yes("readable")
    whole = yes("receipt") & yes("receipt_valid")
    codes = F.array_sort(_told([
        (~sound, "NOTE_REFERENCE_INVALID"), (sound & ~yes("exists"), "NOTE_MISSING"), (there & ~yes("readable"), "NOTE_UNREADABLE"), (open_ & ~yes("valid"), "NOTE_INVALID"), (open_ & ~yes("transcript"), "TRANSCRIPT_MISSING"),
        (open_ & ~yes("preview"), "PREVIEW_MISSING"), (open_ & yes("preview") & ~yes("preview_faithful"), "PREVIEW_STALE"), (open_ & ~yes("review"), "REVIEW_MISSING"), (open_ & yes("review") & ~yes("review_valid"), "REVIEW_INVALID"),
        (open_ & ~yes("receipt"), "READINESS_MISSING"), (open_ & yes("receipt") & ~yes("receipt_valid"), "READINESS_INVALID"), (open_ & whole & ~(yes("review") & yes("transcript") & yes("receipt_current")), "READINESS_STALE"),
        (yes("queued") & ~there, "QUEUE_ORPHAN_REF"), (F.col("stage") == "note", "JOB_STAGED_NOTE"), (F.col("stage") == "review", "JOB_STAGED_REVIEW"), (job & ~there, "JOB_ORPHAN_REF"),
        (there & ~yes("queued") & ~job & ~yes("receipt") & ~yes("published"), "LEGACY_NOTE_UNTRACKED"),
    ]))
    x = x.withColumn("issues", codes)
    has = lambda *names: F.arrays_overlap("issues", F.array(*map(F.lit, names)))
    action = (
        F.when(F.size("issues") == 0, F.lit(None)).when(has("TRANSCRIPT_MISSING") | (has("NOTE_MISSING") & ~yes("transcript")), "restore_source_required").when(has("NOTE_MISSING"), "generate_missing_note")
        .when(has("NOTE_INVALID"), "regenerate_invalid_note").when(has("READINESS_INVALID", "NOTE_REFERENCE_INVALID"), "manual_triage_required").when(has(*REPAIRABLE), "repair_preview_or_review").otherwise("manual_triage_required")
    )
    return x.select("key", yes("queued").alias("queued"), job.alias("job"), "issues", action.alias("action"))


def _told(rules: list[tuple[Column, str]]) -> Column:
    return F.filter(F.array(*(F.when(broken, F.lit(name)) for broken, name in rules)), lambda x: x.isNotNull())


def issue_counts(audited: DataFrame) -> DataFrame:
    """A4: counts of issues, overall and of queued keys."""
    return audited.select("queued", F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"), F.count_if("queued").alias("n_queued"))


def audit_summary(audited: DataFrame) -> DataFrame:
    """One row: counts of keys, queued ones, jobs, those that need action, and issues; and the status: 2 if a receipt or a reference is invalid,
    1 if anything needs action, else 0."""
    bad = F.arrays_overlap("issues", F.array(F.lit("READINESS_INVALID"), F.lit("NOTE_REFERENCE_INVALID")))
    act = F.size("issues") > 0
    counts = audited.agg(F.count("*").alias("notes"), F.count_if("queued").alias("pending"), F.count_if("job").alias("jobs"), F.count_if(act).alias("actionable"), F.count_if(act & F.col("queued")).alias("pending_actionable"), F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("issues"), F.count_if(bad).alias("_bad"))
    return counts.withColumn("status", F.when(F.col("_bad") > 0, 2).when(F.col("actionable") > 0, 1).otherwise(0)).drop("_bad")


def changed(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys of ``after`` that are new or differ in a field, nulls equal."""
    b = before.select(key, *(F.col(f).alias(f"_b_{f}") for f in fields), F.lit(True).alias("_old"))
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_b_{f}"))
    x = after.join(b, key, "left")
    return x.withColumn("kind", F.when(F.col("_old").isNull(), "new").when(~same, "changed")).filter("kind is not null").select(key, "kind")


def stale(receipts: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Receipts whose hashes are no longer the artifacts'."""
    return changed(receipts, current, key, fields).filter("kind = 'changed'")


def planned(transcripts: DataFrame, notes: DataFrame, jobs: DataFrame, audio: DataFrame, forced: Column) -> DataFrame:
    """For each transcript whether a note or review job is due: a note if forced or missing, and then only
    when forced, already a job, or its audio is there."""
    n, j, a = (t.select("key").distinct().withColumn(name, F.lit(True)) for t, name in ((notes, "note"), (jobs, "job"), (audio, "audio")))
    x = transcripts.join(n, "key", "left").join(j, "key", "left").join(a, "key", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    due = (forced | ~yes("note")) & (forced | yes("job") | yes("audio"))
    return x.select("key", F.when(due, "note").when(yes("note") & yes("job"), "review").otherwise("none").alias("plan"))


def routed(items: DataFrame, rules: DataFrame, name: str, default: str | None) -> DataFrame:
    """The project of the first rule (idx, prefix, project) whose prefix the name has, ASCII case aside;
    rules meet names by equality on each length that prefixes have."""
    sizes = rules.agg(F.array_sort(F.collect_set(F.length("prefix"))).alias("sizes"))  # a few numbers
    cut = items.join(F.broadcast(sizes)).withColumn("n", F.explode("sizes")).withColumn("p", F.lower(F.substring(F.col(name), F.lit(1), F.col("n"))))
    hit = cut.join(rules.withColumn("p", F.lower("prefix")), "p").groupBy(name).agg(F.min_by("project", "idx").alias("project"))
    return items.join(hit, name, "left").withColumn("project", F.coalesce("project", F.lit(default), F.lit("unsorted")))


def collision_names(files: DataFrame) -> DataFrame:
    """Target names: the normalised one; for further files of that name a hash of the source; numbered if that clashes too."""
    clean = F.lower(F.regexp_replace(F.trim("name"), r"[^0-9A-Za-z가-힣._-]+", "-"))
    x = files.withColumn("base", clean)
    x = x.withColumn("r", F.row_number().over(Window.partitionBy("base").orderBy("source")))
    x = x.withColumn("target", F.when(F.col("r") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.substring(F.sha2("source", 256), 1, 8))))
    again = F.row_number().over(Window.partitionBy("target").orderBy("source"))
    return x.withColumn("again", again).select("source", F.when(F.col("again") == 1, F.col("target")).otherwise(F.concat_ws("-", "target", F.col("again").cast("string"))).alias("target"))


def upload_decision(local: DataFrame, remote: DataFrame) -> DataFrame:
    """What to do with each note (key, title, hash) given pages (key, title, hash) of the other side:
    skip, update, adopt by a title that is unique, or create."""
    r = remote.select("key", F.col("hash").alias("r_hash"))
    titles = remote.groupBy("title").agg(F.count("*").alias("pages"))
    x = local.join(r, "key", "left").join(titles, "title", "left")
    return x.select("key", F.when(F.col("r_hash") == F.col("hash"), "skip").when(F.col("r_hash").isNotNull(), "update").when(F.col("pages") == 1, "adopt").otherwise("create").alias("decision"))


def upload_outcomes(local: DataFrame, known: DataFrame, pages: DataFrame, upload_baseline: bool = False, refresh_participants: bool = False) -> DataFrame:
    """E31 whole: what to do with each asked note (key, exists, title, hash, participants), given what is known of earlier ones (key, hash, page_id, participants,
    baseline: there before uploads began) and the other side's pages (page_id, title, archived): key, action, reason, page_id. In order: missing; skipped, if it isn't
    Markdown; for an unchanged hash refresh (``refresh_participants``, where they differ and the page is live) or skipped, a baseline one unless
    ``upload_baseline``; update of its live page; adopt, the least live page of its title; create. Of notes of one title that would all be created the first key
    is, the others adopt its page, whose id isn't known yet (null). Keys are unique in each table; null counts as empty, or false."""
    k = known.select("key", F.col("hash").alias("k_hash"), F.nullif("page_id", F.lit("")).alias("k_page"), F.col("participants").alias("k_participants"), F.coalesce("baseline", F.lit(False)).alias("k_baseline"))
    live = pages.filter(~F.coalesce("archived", F.lit(False)))
    x = local.join(k, "key", "left").join(live.select(F.col("page_id").alias("k_page"), F.lit(True).alias("live")), "k_page", "left")
    x = x.join(live.groupBy("title").agg(F.min("page_id").alias("titled")), "title", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    is_live, same = F.coalesce("live", F.lit(False)), F.coalesce(F.col("k_hash") == F.col("hash"), F.lit(False))
    renewed = F.lit(refresh_participants) & has("participants") & is_live & ~F.col("participants").eqNullSafe(F.col("k_participants"))
    old, page = F.coalesce("k_baseline", F.lit(False)), F.col("k_page")
    rules = (
        (~F.coalesce("exists", F.lit(False)), "missing", "no such file", None), (~F.lower("key").endswith(".md"), "skipped", "not Markdown", None),
        (same & renewed, "refresh", "participants", page), (same & old & F.lit(not upload_baseline), "skipped", "baseline", page), (same & ~old, "skipped", "same hash", page),
        (is_live, "update", "changed", page), (F.col("titled").isNotNull(), "adopt", "title is there", F.col("titled")),
    )
    row = lambda action, reason, to: F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"), (F.lit(None).cast("string") if to is None else to).alias("page_id"))
    chosen = row("create", "new", None)
    for when, *what in reversed(rules):
        chosen = F.when(when, row(*what)).otherwise(chosen)
    x = x.select("key", "title", chosen.alias("x")).select("key", "title", "x.*")
    first = x.filter("action = 'create' and title is not null").groupBy("title").agg(F.min("key").alias("first"))
    later = (F.col("action") == "create") & (F.col("key") != F.col("first"))
    x = x.join(first, "title", "left").withColumn("later", F.coalesce(later, F.lit(False)))
    return x.select("key", F.when(F.col("later"), "adopt").otherwise(F.col("action")).alias("action"), F.when(F.col("later"), "title is there").otherwise(F.col("reason")).alias("reason"), "page_id")


def ancestors(blocks: DataFrame, most: int = 6) -> DataFrame:
    """The first title that isn't empty up the chain of parents (id, parent_id, title), within ``most`` levels."""
    up = blocks.select(F.col("id").alias("up_id"), F.col("parent_id").alias("up_parent"), F.col("title").alias("up_title"))
    x = blocks.select("id", F.col("parent_id").alias("at"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("int").alias("depth"))
    for level in range(1, most + 1):  # one join a level; what has its title asks for no parent
        met = F.col("up_title") != ""
        x = x.join(up, F.col("at") == F.col("up_id"), "left").select(
            "id", F.when(met, F.lit(None)).otherwise(F.col("up_parent")).alias("at"), F.when(met, F.col("up_title")).otherwise(F.col("title")).alias("title"), F.when(met, level).otherwise(F.col("depth")).alias("depth")
        )
    return x.filter("depth is not null").groupBy("id").agg(F.min_by("title", "depth").alias("title"), F.min("depth").alias("depth"))
