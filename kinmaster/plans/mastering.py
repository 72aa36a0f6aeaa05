"""The stages chained for account records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.functions.text import normalise_link_text, normalise_text, normalise_zip
from kinmaster.operators import clustering, identity, intake, linkage, quality, refinement, review
from kinmaster.operators.blocking import account_rules
from kinmaster.operators.pair_model import PairModel
from kinmaster.operators.records import prepare_records
from kinmaster.operators.reshape import rename
from kinmaster.schema import ACCOUNT_FIELDS, FieldSpec
from kinmaster.session import materialise, spread

# Records are compared if they share a key of a rule; the score alone decides then.
# A token similarity may be set to compare fewer of very large inputs.
BLOCK_SIMILARITY: float | None = None


def canonical(df: DataFrame) -> DataFrame:
    """Input columns under the names used inside."""
    return rename(df, {k: v for k, v in S.CANONICAL_NAMES.items() if k in df.columns})


def clean_for_dedupe(df: DataFrame, fields: Sequence[FieldSpec] = ACCOUNT_FIELDS) -> DataFrame:
    cleaned = {
        f.name: normalise_text(normalise_zip(F.col(f.name)) if f.name == "zip" else F.col(f.name)) for f in fields
    }
    return df.withColumns(cleaned)


def clean_for_linkage(df: DataFrame, fields: Sequence[FieldSpec] = ACCOUNT_FIELDS, comma: str = " ") -> DataFrame:
    cleaned = {
        f.name: normalise_link_text(normalise_zip(F.col(f.name)) if f.name == "zip" else F.col(f.name), comma)
        for f in fields
    }
    return df.withColumns(cleaned)


def dedupe(
    accounts: DataFrame, record_id: str = "record_number", fields: Sequence[FieldSpec] = ACCOUNT_FIELDS,
    rules: Mapping[str, Column] | None = None, similarity: float | None = BLOCK_SIMILARITY,
    threshold: float = S.DEDUPE_THRESHOLD, refine: float | None = None, model: PairModel | None = None,
) -> DataFrame:
    """Accounts with ``cluster_id`` and ``confidence_score`` in front.

    Clusters are the components of all matches; with ``refine`` they are divided by average linkage at that score.
    With a trained ``model`` its probability decides all through, else the fixed weights.
    """
    records = prepare_records(clean_for_dedupe(spread(accounts), fields), record_id, fields, rules or account_rules())
    clusters, reps, copies = clustering.cluster_records(records, fields, similarity, threshold, model=model)
    clusters = materialise(clusters, "clusters")
    if refine is not None:
        clusters = materialise(refinement.refine_clusters(clusters, reps, copies, fields, refine, model=model), "clusters")
    confidence = clustering.representative_confidence(clusters, reps, copies, fields, model)
    return clustering.cluster_output(accounts, confidence, record_id)


def link(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, fields: Sequence[FieldSpec] = ACCOUNT_FIELDS,
    rules: Mapping[str, Column] | None = None, similarity: float | None = BLOCK_SIMILARITY,
    threshold: float = S.LINK_THRESHOLD, quality_gate: bool = False, comma: str = " ",
    model: PairModel | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(all rows of both inputs with their links, the linked pairs side by side).

    The excluded record type takes no part in matching, and with
    ``quality_gate`` neither do right rows the gate rejects. With a trained ``model`` its probability is the score.
    """
    usable_right = quality.exclude_type(right)
    if quality_gate:
        usable_right, _ = quality.split_quality(usable_right)
    rules = rules or account_rules()
    a = prepare_records(clean_for_linkage(spread(quality.exclude_type(left)), fields, comma), left_id, fields, rules)
    b = prepare_records(clean_for_linkage(spread(usable_right), fields, comma), right_id, fields, rules)
    links = materialise(linkage.link_records(a, b, fields, similarity, threshold, model=model), "links")
    linked = materialise(linkage.link_output(left, right, links, left_id, right_id), "linked")
    return linked, linkage.pair_horizontal(linked)


def label(linked: DataFrame, order: Sequence[str], threshold: float = S.REVIEW_THRESHOLD) -> DataFrame:
    """The review table of linked pairs."""
    linked = linkage.groups_of_size(linked, "cluster_id", 2)
    labels = review.label_pairs(linked, order, threshold=threshold)
    labelled = materialise(review.attach_labels(linked, labels, threshold=threshold), "labelled")
    return review.review_output(review.review_pivot(labelled, order))


def master_accounts(
    extract: DataFrame, master: DataFrame, second: DataFrame, order: Sequence[str], mode: str = "compat",
    pending_policy: str = "compat", similarity: float | None = BLOCK_SIMILARITY,
) -> dict[str, DataFrame]:
    """Intake, deduplication and identity in one go; a table per output.

    ``order`` names the columns that put master and extract rows in file order.
    """
    extract, master, second = canonical(extract), canonical(master), canonical(second)
    appended = materialise(
        intake.append_logbook(master, extract, "q_id", order, "source", S.SPLIT_SOURCE, mode), "appended"
    )
    clustered = materialise(dedupe(appended, similarity=similarity), "clustered")
    last = identity.max_id(master, "final_id").first()
    assigned = identity.assign_ids(clustered, last["max_number"] + 1, pending_policy=pending_policy)
    # IDs are written once: they must never be recomputed from changed inputs.
    flagged = materialise(identity.flag_net_new(assigned, last["max_id"], mode=mode), "assigned")
    missing, found = identity.net_new_split(flagged, second)
    return {
        "new_accounts": appended.where("new_account"),
        "all_accounts": flagged,
        "net_new": identity.net_new_rows(flagged),
        "net_new_unmatched": missing,
        "net_new_matched": found,
        "id_qc": identity.id_qc(flagged),
    }


