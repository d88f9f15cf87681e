"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetweave.llm import decontam, divergence, hard_negatives, licenses, search
from assetweave.llm.ann import op2_kmeans_tree_neighbours
from assetweave.llm.decontam import op5_decontaminate
from assetweave.llm.divergence import op12_divergence_rules
from assetweave.llm.hard_negatives import op13_angular_negatives
from assetweave.llm.licenses import op3_license_rules
from assetweave.llm.ngram_join import op4_ngram_jaccard
from assetweave.llm.packing import op9_pack_sequences
from assetweave.llm.ppm import op7_ppm_scores
from assetweave.llm.quality import op6_quality_crf
from assetweave.llm.search import op11_shared_term_search
from assetweave.llm.secrets import op1_secret_novelty
from assetweave.llm.token_counts import op8_token_counts
from assetweave.llm.wavelet import op10_token_shards

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_novelty,
        op2_kmeans_tree_neighbours,
        op3_license_rules,
        op4_ngram_jaccard,
        op5_decontaminate,
        op6_quality_crf,
        op7_ppm_scores,
        op8_token_counts,
        op9_pack_sequences,
        op10_token_shards,
        op11_shared_term_search,
        op12_divergence_rules,
        op13_angular_negatives,
    )
}

#: SQL twins, where SQL can express the operator
ORACLE: dict[str, str] = {
    "op3_license_rules": licenses.oracle(),
    "op5_decontaminate": decontam.oracle(),
    "op11_shared_term_search": search.oracle(),
    "op12_divergence_rules": divergence.oracle(),
    "op13_angular_negatives": hard_negatives.oracle(),
}
