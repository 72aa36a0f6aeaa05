"""Account mastering on Spark: intake, deduplication, identity, linkage, review.

Every operator is a function from DataFrame to DataFrame; nothing here holds
state between calls. ``kinmaster.plans.mastering`` chains them end to end.
"""

__version__ = "0.1.0"
