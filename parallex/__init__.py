"""parallex: parallel-text preparation and translation evaluation on Spark.

Every public function takes and returns DataFrames (or Columns) built from
built-in Spark expressions, joins and aggregates, so Catalyst plans the work
and it scales with the cluster.
"""

from parallex.config import Options, SPECIAL_TOKENS, UNK_ID, PAD_ID, SOS_ID, EOS_ID

__all__ = ["Options", "SPECIAL_TOKENS", "UNK_ID", "PAD_ID", "SOS_ID", "EOS_ID"]
