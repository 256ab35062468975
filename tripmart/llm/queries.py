"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tripmart.llm import conversation_trie, decontaminate, itq_dedup, secret_scan, warc_audit
from tripmart.llm.debruijn_dedup import op4_debruijn_dedup
from tripmart.llm.language_id import op8_language_id
from tripmart.llm.line_dedup import op9_line_dedup
from tripmart.llm.mixing import op7_mixing
from tripmart.llm.periodic_runs import op11_periodic_runs
from tripmart.llm.quality_crf import op13_quality_crf
from tripmart.llm.simhash_dedup import op6_simhash_dedup
from tripmart.llm.suffix_dedup import op1_suffix_dedup

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_warc_audit": warc_audit.op2_warc_audit,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_debruijn_dedup": op4_debruijn_dedup,
    "op5_itq_dedup": itq_dedup.op5_itq_dedup,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_trie": conversation_trie.op12_conversation_trie,
    "op13_quality_crf": op13_quality_crf,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op2_warc_audit": warc_audit.ORACLE,
    "op3_secret_scan": secret_scan.ORACLE,
    "op5_itq_dedup": itq_dedup.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op12_conversation_trie": conversation_trie.ORACLE,
}
