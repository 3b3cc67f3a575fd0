"""Training-data operators on Spark DataFrames.

  mixing          sources mixed to target weights (hierarchical budgets)
  packing         documents packed into fixed-length token sequences
  simhash_pivots  SimHash near-dedup with pivot distance tables
  gru_lm          gated recurrent language model scores
  simhash_blocks  SimHash fingerprints and permuted block tables (DataFrame functions only)
  toxicity        compression-distance toxicity scores
  language_id     compression language identification
  line_dedup      repeated-line removal (DataFrame functions only)
  ego_join        embedding near-duplicates by an epsilon grid order join
  pii             personal data found by anchor expansion
  licenses        license scan by an exact set-similarity join (DataFrame functions only)
  token_align     tokens of two tokenizers aligned by byte offsets
  importance      target-distribution importance resampling, distributed radix sort
  queries         the registered opN_<name> queries and their DuckDB SQL

Nothing outside this package imports it. Functions that run in Python workers
are sent by value, so the workers need only the public libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
