"""One registered query per operator, over the tables at hand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.functions.similarity import hashed_words, string_ratio
from kinmaster.functions.text import (
    format_time,
    is_pending,
    normalise_key,
    normalise_link_text,
    normalise_text,
    normalise_zip,
)
from kinmaster.operators import (
    blocking,
    clustering,
    identity,
    index_blocking,
    intake,
    linkage,
    numbering,
    pair_model,
    quality,
    records,
    refinement,
    reshape,
    review,
    scoring,
)
from kinmaster.operators.joins import join_back
from kinmaster.plans import mastering, roles
from kinmaster.schema import ACCOUNT_FIELDS
from kinmaster.session import materialise, release, scratch_path, spread
from kinmaster.sources import readers, writers
from kinmaster.streaming import intake as stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SAMPLE = 100
REVIEW_QUEUE = 50
BETA = 0.5
# Accounts are joined from 0.5 on and divided where they are not that much alike.
REFINE_CUT = 0.6
INDEX_COSINE = 0.7
# A logistic scorer as one might have been trained before; one weight is below 0.
STATED_MODEL = pair_model.PairModel(
    intercept=-6.0, similar={"name": 6.0, "address": 3.5, "city": -0.5, "state": 1.0, "zip": 1.5},
    missing={"address": 1.5, "city": 0.2, "state": 0.3, "zip": 0.8},
)
RUN_TIME = "2024-01-31 06:00:00"
RECEIVED = "2024-01-31"


def query(function: Query) -> Query:
    """Register under the function's name; ``_values`` only avoids a name clash."""
    REGISTRY[function.__name__.removesuffix("_values")] = function
    return function


# --- intake -------------------------------------------------------------------


@query
def scan_select(spark, sf_dir):
    lines = readers.read_table(spark, f"{sf_dir}/lineitem.parquet")
    return reshape.select_columns(lines, ["l_orderkey", "l_linenumber", "l_returnflag"])


@query
def profile(spark, sf_dir):
    return intake.profile(roles.table(spark, sf_dir, "lineitem"))


@query
def head(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return intake.head(orders, ["o_orderkey"], 5)


@query
def run_stats(spark, sf_dir):
    return intake.run_stats(roles.table(spark, sf_dir, "lineitem"))


@query
def source_split(spark, sf_dir):
    chosen, rest = intake.split_by_source(roles.extract(spark, sf_dir), "source", roles.SPLIT_VALUE)
    return reshape.union_all(
        reshape.with_constant(chosen, "part", "split"), reshape.with_constant(rest, "part", "rest")
    )


@query
def intake_new(spark, sf_dir):
    return intake.new_records(roles.extract(spark, sf_dir), roles.master(spark, sf_dir), "q_id")


@query
def intake_new_strict(spark, sf_dir):
    return intake.new_records(roles.extract(spark, sf_dir), roles.master(spark, sf_dir), "q_id", "strict")


@query
def intake_not_found(spark, sf_dir):
    return intake.known_with_status(
        roles.extract(spark, sf_dir), roles.master(spark, sf_dir), "q_id", "final_status"
    )


@query
def intake_counts(spark, sf_dir):
    return intake.intake_counts(
        roles.extract(spark, sf_dir), roles.master(spark, sf_dir), "q_id", "final_status", "source",
        roles.SPLIT_VALUE,
    )


@query
def combined_status(spark, sf_dir):
    return intake.combined_status(
        roles.extract(spark, sf_dir), roles.master(spark, sf_dir), "q_id", "final_status"
    )


@query
def new_accounts(spark, sf_dir):
    new = intake.new_records(roles.extract(spark, sf_dir), roles.master(spark, sf_dir), "q_id")
    stamped = intake.new_accounts_export(new, RECEIVED)
    return stamped.withColumn("date_received", format_time(F.col("date_received"), "MM/dd/yyyy"))


@query
def append_logbook(spark, sf_dir):
    return intake.append_logbook(
        roles.master(spark, sf_dir), roles.extract(spark, sf_dir), "q_id", ["ordinal"], "source",
        roles.SPLIT_VALUE, renames={"ship_to": "name"},
    )


@query
def new_by_source(spark, sf_dir):
    return intake.new_by_source(intake_new(spark, sf_dir), "source", "q_id")


@query
def distinct_pairs(spark, sf_dir):
    return intake.distinct_count(roles.master(spark, sf_dir), "q_id", "source")


@query
def distinct_all_columns(spark, sf_dir):
    return intake.distinct_all_columns(intake_new(spark, sf_dir), "source")


@query
def distinct_all_columns_total(spark, sf_dir):
    return intake.distinct_all_columns_total(distinct_all_columns(spark, sf_dir))


@query
def rename_reorder(spark, sf_dir):
    renamed = reshape.rename(roles.extract(spark, sf_dir), {"ship_to": "name", "ship_to_code": "code"})
    return reshape.to_front(renamed, ["code", "name"])


@query
def drop_empty_columns(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus",
        "CASE WHEN o_totalprice < 0 THEN o_orderpriority END AS never",
        "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS sometimes",
    )
    return reshape.drop_empty_columns(orders)


@query
def align_columns(spark, sf_dir):
    return reshape.align_columns(roles.extract(spark, sf_dir), ["source", "comments", "q_id"], ["ship_to"])


@query
def normalise_key_values(spark, sf_dir):
    return roles.extract(spark, sf_dir).select(
        "ordinal",
        normalise_key(F.col("q_id")).alias("compat_key"),
        normalise_key(F.col("q_id"), "strict").alias("strict_key"),
    )


@query
def sink_roundtrip(spark, sf_dir):
    """Written as CSV and as one table of a set, read back and put together."""
    extract = roles.extract(spark, sf_dir).select(F.col("ordinal").cast("string"), "q_id", "source")
    root = scratch_path(spark, "sinks")
    path = writers.write_table(extract.where("source IS NOT NULL"), f"{root}/extract.csv", run_id="r1")
    writers.write_set({"no source": extract.where("source IS NULL")}, f"{root}/set")
    back = readers.read_table(spark, path.split("/run_id=")[0], S.text_schema("ordinal", "q_id", "source"))
    return back.select("ordinal", "q_id", "source").unionByName(writers.read_set(spark, f"{root}/set", "no source")["no source"])


@query
def latest_file(spark, sf_dir):
    """Files by name with their versions, the newest by name and by time marked."""
    files = readers.list_files(spark, sf_dir)
    newest = readers.latest_versioned(spark, sf_dir)
    last = readers.latest_by_time(spark, sf_dir)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length", "major", "minor",
        (F.col("path") == newest).alias("highest_version"),
        (F.col("path") == last).alias("latest"),
    )


# --- cleaning -----------------------------------------------------------------


@query
def normalise_text_values(spark, sf_dir):
    return spread(roles.table(spark, sf_dir, "documents")).select("doc_id", normalise_text(F.col("text")).alias("text"))


@query
def normalise_link_text_values(spark, sf_dir):
    return spread(roles.table(spark, sf_dir, "documents")).select(
        "doc_id",
        normalise_link_text(F.col("text")).alias("spaced"),
        normalise_link_text(F.col("text"), comma="").alias("removed"),
    )


@query
def normalise_zip_values(spark, sf_dir):
    return roles.customers(spark, sf_dir).select(
        "record_number",
        normalise_zip(F.col("zip")).alias("strict_zip"),
        normalise_zip(F.col("zip"), "compat").alias("compat_zip"),
    )


@query
def quality_kept(spark, sf_dir):
    return quality.split_quality(quality.require_non_blank(roles.customers(spark, sf_dir), "record_type"))[0]


@query
def quality_dropped(spark, sf_dir):
    return quality.split_quality(roles.customers(spark, sf_dir))[1]


@query
def exclude_type(spark, sf_dir):
    return quality.exclude_type(roles.customers(spark, sf_dir), value="household")


@query
def excluded_count(spark, sf_dir):
    return quality.excluded_count(roles.customers(spark, sf_dir), value="household")


# --- identity -----------------------------------------------------------------


@query
def id_pending(spark, sf_dir):
    return roles.clustered(spark, sf_dir).withColumn("pending", is_pending(F.col("final_id")))


@query
def id_pending_counts(spark, sf_dir):
    return identity.pending_counts(roles.clustered(spark, sf_dir), "final_id")


@query
def id_max(spark, sf_dir):
    return identity.max_id(roles.clustered(spark, sf_dir), "final_id")


@query
def id_max_text(spark, sf_dir):
    return identity.max_id_text(roles.clustered(spark, sf_dir), "final_id")


@query
def id_assign(spark, sf_dir):
    accounts = roles.clustered(spark, sf_dir)
    return identity.assign_ids(accounts, master=accounts)


@query
def id_assign_strict(spark, sf_dir):
    accounts = roles.clustered(spark, sf_dir)
    return identity.assign_ids(accounts, master=accounts, pending_policy="strict")


@query
def attach_ids(spark, sf_dir):
    """Accounts beside the first ID their cluster was ever given."""
    accounts = roles.clustered(spark, sf_dir)
    given = accounts.where(F.col("final_id").startswith(S.ID_PREFIX)).groupBy("cluster_id").agg(F.min("final_id").alias("given_id"))
    return identity.attach_ids(accounts.select("record_number", "cluster_id"), given, "cluster_id")


@query
def id_qc_counts(spark, sf_dir):
    return identity.id_qc(id_assign(spark, sf_dir))


@query
def id_qc_duplicates(spark, sf_dir):
    return identity.duplicate_ids(id_assign(spark, sf_dir))


@query
def ids_per_cluster(spark, sf_dir):
    return identity.ids_per_cluster(roles.clustered(spark, sf_dir))


@query
def cluster_conflict(spark, sf_dir):
    return identity.cluster_conflict(roles.clustered(spark, sf_dir))


def _flagged(spark, sf_dir, mode="strict"):
    accounts = roles.clustered(spark, sf_dir)
    last = identity.max_id(accounts, "final_id").first()
    assigned = identity.assign_ids(accounts, last["max_number"] + 1)
    return identity.flag_net_new(assigned, last["max_id"], mode=mode)


@query
def net_new(spark, sf_dir):
    return _flagged(spark, sf_dir)


@query
def net_new_compat(spark, sf_dir):
    return _flagged(spark, sf_dir, "compat")


@query
def net_new_unmatched(spark, sf_dir):
    split = identity.net_new_split(
        _flagged(spark, sf_dir), roles.codes(spark, sf_dir), export_names={"cluster_id": "Dedupe_Cluster ID"}
    )
    return split[0]


@query
def net_new_matched(spark, sf_dir):
    return identity.net_new_split(_flagged(spark, sf_dir), roles.codes(spark, sf_dir))[1]


@query
def seq_id_per_cluster(spark, sf_dir):
    orders = roles.clustered(spark, sf_dir).select("record_number", "cluster_id")
    return identity.seq_id_per_cluster(orders)


@query
def run_log(spark, sf_dir):
    """The run's row appended to a log and the log read back."""
    path = scratch_path(spark, "run_log")
    writers.append_run_log(identity.run_log_row(_flagged(spark, sf_dir), RUN_TIME), path)
    return spark.read.parquet(path).withColumn("run_time", format_time(F.col("run_time"), "yyyy-MM-dd HH:mm:ss"))


@query
def entry_number(spark, sf_dir):
    lines = roles.clustered(spark, sf_dir).select("record_number", "cluster_id")
    return numbering.entry_number(lines, "cluster_id", ["record_number"])


# --- matching -----------------------------------------------------------------


def _records(spark, sf_dir, keep=()):
    return records.prepare_records(
        roles.documents(spark, sf_dir), "doc_id", roles.DOCUMENT_FIELDS, roles.document_rules(), keep
    )


def _scored(spark, sf_dir):
    """Scored pairs of documents that differ in something compared."""
    fields = roles.DOCUMENT_FIELDS
    prepared = _records(spark, sf_dir)
    reps, copies = records.collapse_copies(prepared, fields)
    release(prepared)
    return blocking.candidate_pairs(reps, fields, roles.DOCUMENT_SIMILARITY), reps, copies


@query
def block_pairs(spark, sf_dir):
    return _scored(spark, sf_dir)[0].select("left_id", "right_id", "similarity", "shared_keys")


@query
def rule_coverage(spark, sf_dir):
    """How the rules, and the plain columns as rules, cover the copies found."""
    rules = {
        **roles.document_rules(),
        "first_word": blocking.rule_first_token("text"),
        "length": blocking.rule_exact("n_chars"),
        "lang": blocking.rule_exact("lang"),
    }
    # All rules' keys are worked out once, and written with the records.
    ruled = {rule: F.col(f"rule_{rule}") for rule in rules}
    docs = roles.documents(spark, sf_dir).withColumns({f"rule_{rule}": keys for rule, keys in rules.items()})
    kept = [f"rule_{rule}" for rule in rules]
    prepared = records.prepare_records(
        docs, "doc_id", roles.DOCUMENT_FIELDS, {rule: ruled[rule] for rule in roles.document_rules()}, kept
    )
    keys = materialise(blocking.block_keys(prepared, "record_id", ruled), "keys")
    _, copies = records.collapse_copies(prepared.drop(*kept), roles.DOCUMENT_FIELDS)
    labels = copies.where("record_id <> rep_id").selectExpr("rep_id AS left_id", "record_id AS right_id", "1 AS is_match")
    return blocking.rule_coverage(labels, keys)


@query
def score_pairs(spark, sf_dir):
    return _scored(spark, sf_dir)[0]


@query
def pair_sample(spark, sf_dir):
    # Read three times: counted, cut and ordered.
    scored = materialise(_scored(spark, sf_dir)[0].select("left_id", "right_id", "score"), "scored")
    return scoring.sample_pairs(scored, SAMPLE)


@query
def uncertain_pairs(spark, sf_dir):
    return scoring.uncertain_pairs(_scored(spark, sf_dir)[0].select("left_id", "right_id", "score"), REVIEW_QUEUE)


@query
def minhash_pairs(spark, sf_dir):
    reps, _ = records.collapse_copies(_records(spark, sf_dir), roles.DOCUMENT_FIELDS)
    return blocking.minhash_pairs(reps, roles.DOCUMENT_FIELDS, max_distance=0.3)


@query
def connected_components(spark, sf_dir):
    fields = roles.DOCUMENT_FIELDS
    clusters, _, _ = clustering.cluster_records(_records(spark, sf_dir), fields, roles.DOCUMENT_SIMILARITY)
    return clusters


@query
def cluster_confidence(spark, sf_dir):
    scored, reps, copies = _scored(spark, sf_dir)
    scored = materialise(scored.select("left_id", "right_id", "score"), "scored")
    links = scored.where(F.col("score") >= S.DEDUPE_THRESHOLD)
    found = clustering.connected_components(reps, links)
    found = found.withColumnRenamed("record_id", "rep_id")
    clusters = join_back(copies, found, "rep_id", "rep_id").select("record_id", "component")
    return clustering.cluster_confidence(clusters, scored, copies, reps)


@query
def cluster_output(spark, sf_dir):
    fields = roles.DOCUMENT_FIELDS
    clusters, reps, copies = clustering.cluster_records(_records(spark, sf_dir), fields, roles.DOCUMENT_SIMILARITY)
    confidence = clustering.representative_confidence(materialise(clusters, "clusters"), reps, copies, fields)
    return clustering.cluster_output(roles.table(spark, sf_dir, "documents"), confidence, "doc_id")


@query
def cluster_count(spark, sf_dir):
    return clustering.cluster_count(connected_components(spark, sf_dir), "component")


# --- linkage ------------------------------------------------------------------


def _links(spark, sf_dir):
    prepared = _records(spark, sf_dir, keep=["source"])
    left = prepared.where(roles.is_left()).drop("source")
    right = prepared.where(~roles.is_left()).drop("source")
    return linkage.link_records(left, right, roles.DOCUMENT_FIELDS, roles.DOCUMENT_SIMILARITY)


def _linked(spark, sf_dir):
    documents = roles.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    left, right = documents.where(roles.is_left()), documents.where(~roles.is_left())
    return linkage.link_output(left, right, materialise(_links(spark, sf_dir), "links"), "doc_id", "doc_id")


@query
def link_best(spark, sf_dir):
    return _links(spark, sf_dir)


@query
def link_resolved(spark, sf_dir):
    return linkage.resolve_right(_links(spark, sf_dir))


@query
def link_output(spark, sf_dir):
    return _linked(spark, sf_dir)


@query
def pair_horizontal(spark, sf_dir):
    linked = reshape.with_constant(_linked(spark, sf_dir), "comments", None)
    return linkage.pair_horizontal(materialise(linked.withColumn("comments", F.col("comments").cast("string")), "linked"))


@query
def index_pairs(spark, sf_dir):
    """Documents whose weighted words have a cosine of 0.7, a document for each set of words."""
    docs = roles.documents(spark, sf_dir).select(F.col("doc_id").alias("record_id"), hashed_words(F.col("text")).alias("tokens"))
    return index_blocking.similar_sets(materialise(docs, "documents"), INDEX_COSINE, spent=True)[0]


# --- accounts -----------------------------------------------------------------


@query
def dedupe_accounts(spark, sf_dir):
    """Customers as accounts in clusters: all rules, all five fields, no similarity cut."""
    return mastering.dedupe(roles.accounts(spark, sf_dir), "id")


@query
def refine_accounts(spark, sf_dir):
    """Clusters of accounts, divided by average linkage, beside the components they come from."""
    records_ = records.prepare_records(
        mastering.clean_for_dedupe(spread(roles.accounts(spark, sf_dir))), "id", ACCOUNT_FIELDS, blocking.account_rules()
    )
    clusters, reps, copies = clustering.cluster_records(records_, ACCOUNT_FIELDS, None)
    clusters = materialise(clusters, "clusters")
    refined = refinement.refine_clusters(clusters, reps, copies, ACCOUNT_FIELDS, REFINE_CUT)
    return refined.withColumnRenamed("component", "refined").join(clusters, "record_id")


def _linked_accounts(spark, sf_dir):
    return mastering.link(roles.accounts(spark, sf_dir), roles.crm_accounts(spark, sf_dir), "id", "id")


@query
def link_accounts(spark, sf_dir):
    """Both account datasets with their links from a score of 0.1 up."""
    return _linked_accounts(spark, sf_dir)[0]


@query
def review_accounts(spark, sf_dir):
    """Links below the review threshold with their labels."""
    return mastering.label(_linked_accounts(spark, sf_dir)[0], ["source_file", "id"])


@query
def model_dedupe(spark, sf_dir):
    """Clusters of accounts where a trained model decides, in small blocks and large ones."""
    return mastering.dedupe(roles.accounts(spark, sf_dir), "id", model=STATED_MODEL)


@query
def model_links(spark, sf_dir):
    """Links of the account datasets by a trained model's probability."""
    left, right = roles.accounts(spark, sf_dir), roles.crm_accounts(spark, sf_dir)
    return mastering.link(left, right, "id", "id", model=STATED_MODEL)[0]


def learnt_model(spark, sf_dir):
    """A model of labelled pairs. Accounts are known to be those of the supplier with a third of their number; of even thirds
    that pair is a match, and the two suppliers after it are none."""
    rules = blocking.account_rules()
    left, right = (
        records.prepare_records(mastering.clean_for_linkage(spread(side)), "id", ACCOUNT_FIELDS, rules)
        for side in (roles.accounts(spark, sf_dir), roles.crm_accounts(spark, sf_dir))
    )
    known = left.where("(record_id div 3) % 2 = 0").selectExpr("record_id AS left_id", "explode(sequence(0, 2)) AS away")
    labels = known.selectExpr("left_id", "left_id div 3 + away AS right_id", "CAST(away = 0 AS INT) AS is_match")
    featured = materialise(scoring.labelled_features(labels, left, right, ACCOUNT_FIELDS), "labelled")
    return pair_model.PairModel.of(scoring.train_scorer(featured, ACCOUNT_FIELDS))


@query
def learnt_links(spark, sf_dir):
    """Labels joined to features, a model fitted, and the account datasets linked where it finds a match likely."""
    left, right = roles.accounts(spark, sf_dir), roles.crm_accounts(spark, sf_dir)
    return mastering.link(left, right, "id", "id", threshold=0.5, model=learnt_model(spark, sf_dir))[0]


@query
def versioned_set(spark, sf_dir):
    """Two versions of a set written, the newest one found again and read."""
    root = scratch_path(spark, "versions")
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("F", "O"):
        target = writers.next_version(spark, root, "Orders ")
        writers.write_set({"orders": orders.where(F.col("o_orderstatus") == status)}, target)
    newest = readers.latest_versioned(spark, root, "Orders ")
    return writers.read_set(spark, newest, "orders")["orders"]


@query
def by_group_size(spark, sf_dir):
    return linkage.by_group_size(roles.clustered(spark, sf_dir).select("record_number", "cluster_id"), "cluster_id")


# --- review -------------------------------------------------------------------


@query
def string_ratio_values(spark, sf_dir):
    parts = roles.table(spark, sf_dir, "part")
    return parts.select("p_partkey", string_ratio(F.col("p_name"), F.concat_ws(" ", "p_type", "p_brand")).alias("ratio"))


def _entry_pairs(spark, sf_dir):
    return review.entry_pairs(
        roles.review(spark, sf_dir), "cluster_id", roles.REVIEW_ORDER, ["name", "address", "city", "state", "zip"]
    )


def _features(spark, sf_dir):
    return scoring.pair_features(_entry_pairs(spark, sf_dir), ACCOUNT_FIELDS, "first_", "second_")


def _feature_list():
    return [n for f in ACCOUNT_FIELDS for n in (f"sim_{f.name}", f"missing_{f.name}")]


@query
def pair_features(spark, sf_dir):
    scored = scoring.score_pairs(_features(spark, sf_dir), ACCOUNT_FIELDS)
    return scored.select("cluster_id", *_feature_list(), "score")


def _labels(spark, sf_dir):
    return review.label_pairs(roles.review(spark, sf_dir), roles.REVIEW_ORDER)


@query
def label_pairs(spark, sf_dir):
    return _labels(spark, sf_dir)


@query
def label_adjust(spark, sf_dir):
    rows = roles.review(spark, sf_dir)
    labelled = review.attach_labels(rows, _labels(spark, sf_dir))
    return labelled.select(
        "cluster_id", "source_file", "ordinal", "id", "link_score", "label", "name_similarity",
        "address_similarity", "adjusted_link_score",
    )


@query
def label_pivot(spark, sf_dir):
    labelled = materialise(review.attach_labels(roles.review(spark, sf_dir), _labels(spark, sf_dir)), "labelled")
    pivoted = review.review_pivot(labelled, roles.REVIEW_ORDER)
    present = [c for c in review.review_order() if c in pivoted.columns]
    return review.review_output(pivoted, present)


@query
def label_store(spark, sf_dir):
    pairs = roles.table(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus", "l_orderkey AS left_id", "l_partkey AS right_id",
        "CAST(l_returnflag = 'R' AS INT) AS is_match", "date_format(l_shipdate, 'yyyy-MM-dd') AS labelled_at",
    )
    store, new = pairs.where("l_linestatus = 'F'"), pairs.where("l_linestatus = 'O'")
    return scoring.upsert_labels(store.drop("l_linestatus"), new.drop("l_linestatus"))


@query
def threshold_fbeta(spark, sf_dir):
    features = _features(spark, sf_dir).withColumn("is_match", F.col("first_state").eqNullSafe(F.col("second_state")))
    return scoring.threshold_fbeta(scoring.score_pairs(features, ACCOUNT_FIELDS), BETA)


@query
def threshold_curve(spark, sf_dir):
    features = _features(spark, sf_dir).withColumn("is_match", F.col("first_state").eqNullSafe(F.col("second_state")))
    return scoring.threshold_curve(scoring.score_pairs(features, ACCOUNT_FIELDS), BETA)


@query
def expected_curve(spark, sf_dir):
    """Cuts judged by the scores alone, taken as probabilities."""
    return scoring.expected_curve(scoring.score_pairs(_features(spark, sf_dir), ACCOUNT_FIELDS), BETA)


@query
def expected_threshold(spark, sf_dir):
    return scoring.expected_threshold(scoring.score_pairs(_features(spark, sf_dir), ACCOUNT_FIELDS), BETA)


@query
def train_scorer(spark, sf_dir):
    """Pairs scored by a model learnt from the review labels."""
    labelled = (
        _features(spark, sf_dir)
        .select("cluster_id", *_feature_list(), string_ratio(F.col("first_name"), F.col("second_name")).alias("r"))
        .withColumn("is_match", (F.col("r") >= S.NAME_CUT).cast("int"))
    )
    labelled = materialise(labelled, "labelled")
    model = scoring.load_or_train(scratch_path(spark, "model"), labelled, ACCOUNT_FIELDS)
    return scoring.score_pairs(labelled, ACCOUNT_FIELDS, model).select("cluster_id", "is_match", "score")


# --- streaming ----------------------------------------------------------------


@query
def stream_intake(spark, sf_dir):
    """The extract arriving as a file, new records kept by a streaming query."""
    orders = roles.table(spark, sf_dir, "orders").schema
    arriving = stream.stream_files(spark, sf_dir, "orders", orders, "parquet", ".parquet")
    sink, checkpoint = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_checkpoint")
    running = stream.stream_intake(
        roles.as_extract(arriving), lambda _: roles.master(spark, sf_dir), sink, checkpoint, "q_id"
    )
    running.awaitTermination()
    return stream.accepted(spark, sink, roles.extract(spark, sf_dir).schema)
