"""sylvan — labelled-text classification with one-vs-rest gain-ratio forests on Spark.

Pipeline (every step DataFrame -> DataFrame):

    clean -> tokens -> split -> postings / vocabulary / doc_terms
          -> grow_forest (one aggregation per level for all trees)
          -> predict (broadcast node-table walk) -> vote -> accuracy
"""

from sylvan.session import get_spark, checkpoint_dir  # noqa: F401
