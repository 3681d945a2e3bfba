"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tillmark.llm import collocations
from tillmark.llm.context_mixing import op10_lm_scoring
from tillmark.llm.fingerprints import op7_document_fingerprints
from tillmark.llm.jaccard_join import op4_ngram_jaccard_join
from tillmark.llm.line_dedup import op8_line_dedup
from tillmark.llm.minhash import op13_minhash_near_dedup
from tillmark.llm.mixing import op6_source_mixing
from tillmark.llm.nearest import op5_nearest_neighbours
from tillmark.llm.packing import op9_best_fit_packing
from tillmark.llm.suffix_dedup import op1_suffix_array_dedup
from tillmark.llm.token_counts import op3_token_counts
from tillmark.llm.toxicity import op2_toxicity
from tillmark.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_source_mixing": op6_source_mixing,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_line_dedup": op8_line_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

ORACLES = {"op12_phrase_collocations": collocations.SQL}
