"""The registered queries of this folder and their SQL."""

import corpus_pipeline
from touchline.llm import bwt_dedup, collocations, decontaminate, exact_dedup, jaccard, lexical, line_runs, lm_score, packing, phrase_dedup, quality, revisits, sharding

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_cross_entropy_difference": lm_score.op2_cross_entropy_difference,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_revisit_resolution": revisits.op4_revisit_resolution,
    "op5_phrase_automata": phrase_dedup.op5_phrase_automata,
    "op6_qgram_decontamination": decontaminate.op6_qgram_decontamination,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_vertical_jaccard": jaccard.op8_vertical_jaccard,
    "op9_external_shuffle": sharding.op9_external_shuffle,
    "op10_bwt_dedup": bwt_dedup.op10_bwt_dedup,
    "op11_phrase_fingerprints": collocations.op11_phrase_fingerprints,
    "op12_block_max_search": lexical.op12_block_max_search,
    "op13_levelled_line_dedup": line_runs.op13_levelled_line_dedup,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op5_phrase_automata": phrase_dedup.OP5_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op8_vertical_jaccard": jaccard.OP8_SQL,
    "op11_phrase_fingerprints": collocations.OP11_SQL,
    "op12_block_max_search": lexical.OP12_SQL,
    "op13_levelled_line_dedup": line_runs.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
