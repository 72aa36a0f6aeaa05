"""Field declarations, column vocabularies and fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Results depend on these being exactly as written.
ID_PREFIX = "EMUSHCO"
ID_WIDTH = 7
PENDING_TEXT = "pending"
MISSING_KEY = "NAN"
SPLIT_SOURCE = "ExFactory"
NOT_FOUND = "Not Found"
PENDING_STATUS = "Pending"
EXCLUDED_TYPE = "trade partner"
DEDUPE_THRESHOLD = 0.5
LINK_THRESHOLD = 0.1
REVIEW_THRESHOLD = 0.520
NAME_CUT = 0.70
ADDRESS_CUT = 0.80
TRAINING_SAMPLE = 150_000
TRAINING_RECALL = 0.75
LEFT_PREFIX = "SFDC_"
RIGHT_PREFIX = "ExFactory_"
REVIEW_LEFT_PREFIX = "SFDC_Acc_"
REVIEW_RIGHT_PREFIX = "ExFactory_"

# The review labels and the score each one is moved to.
# ``None`` stands for the review threshold itself.
LABEL_RELIABLE = "Reliable match"
LABEL_SAME_ADDRESS = "Name mismatch, address same"
LABEL_SAME_NAME = "Name match, address different"
LABEL_NEITHER = "Name and Address do not match"
LABEL_OTHER = "Other"
ADJUSTED_SCORE = {
    LABEL_SAME_ADDRESS: 0.3,
    LABEL_SAME_NAME: 0.2,
    LABEL_NEITHER: 0.1,
    LABEL_RELIABLE: None,
}

# Names at the edges -> names inside.
CANONICAL_NAMES = {
    "Record Number": "record_number",
    "Cluster ID": "cluster_id",
    "Link Score": "link_score",
    "Adjusted Link Score": "adjusted_link_score",
    "Final MDM ID": "final_id",
    "Final - Status": "final_status",
    "Net New Accounts": "net_new",
    "New_Account": "new_account",
    "Date_New_Accounts_Received": "date_received",
    "Source": "source",
    "Q_ID": "q_id",
    "ShipTo": "name",
    "ShipTo Code": "ship_to_code",
    "ShipTo Number": "ship_to_number",
    "SFDC ID": "crm_id",
    "Id": "crm_id",
    "Name": "name",
    "Address": "address",
    "City": "city",
    "State": "state",
    "Zip": "zip",
    "ShippingStreet": "address",
    "ShippingCity": "city",
    "ShippingState": "state",
    "ShippingPostalCode": "zip",
    "RecordType": "record_type",
    "source file": "source_file",
}

# Names the net-new export uses.
NET_NEW_EXPORT_NAMES = {
    "cluster_id": "Dedupe_Cluster ID",
    "confidence_score": "Dedupe_confidence_score",
    "address": "ShippingStreet",
    "city": "ShippingCity",
    "state": "ShippingState",
    "zip": "ShippingPostalCode",
}


@dataclass(frozen=True)
class FieldSpec:
    """How one field takes part in matching.

    ``kind``: ``string`` compares by edit distance, ``text`` by shared words
    (for long values), ``exact`` by equality. With ``has_missing`` a blank on
    either side leaves the field out of the score instead of counting as a
    difference.
    """

    name: str
    kind: str = "string"
    has_missing: bool = False
    weight: float = 1.0

    def __post_init__(self) -> None:
        if self.kind not in ("string", "text", "exact"):
            raise ValueError(f"unknown field kind {self.kind!r}")


# The account fields and how each is compared.
ACCOUNT_FIELDS = (
    FieldSpec("name", "string", weight=0.4),
    FieldSpec("address", "string", has_missing=True, weight=0.3),
    FieldSpec("city", "string", has_missing=True, weight=0.1),
    FieldSpec("state", "exact", has_missing=True, weight=0.1),
    FieldSpec("zip", "string", has_missing=True, weight=0.1),
)


def text_schema(*columns: str) -> T.StructType:
    """Every business column is read as text (zips and codes keep their zeros)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


EXTRACT_SCHEMA = text_schema(
    "Source", "Q_ID", "ShipTo", "Address", "City", "State", "Zip", "ShipTo Code"
)
MASTER_SCHEMA = text_schema(
    "Source", "Q_ID", "ShipTo Code", "Final - Status", "Final MDM ID",
    "Name", "Address", "City", "State", "Zip",
)
SECOND_SCHEMA = text_schema(
    "SFDC ID", "Name", "Address", "City", "State", "Zip", "ShipTo Number", "RecordType"
)
