"""The queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from casemill.llm import collocations, exactdedup, hostrules, infill, topk
from casemill.llm.bytebpe import op3_byte_bpe
from casemill.llm.licenses import op10_license_scans
from casemill.llm.neardup import op5_minhash_near_dedup
from casemill.llm.packing import op1_best_fit_packing
from casemill.llm.pii import op8_pii
from casemill.llm.substrings import op2_substring_dedup
from casemill.llm.tokencount import op6_token_counts
from casemill.llm.toxicity import op7_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_substring_dedup,
        op3_byte_bpe,
        topk.op4_exact_top_k,
        op5_minhash_near_dedup,
        op6_token_counts,
        op7_toxicity,
        op8_pii,
        hostrules.op9_quality_rules,
        op10_license_scans,
        collocations.op11_collocations,
        infill.op12_fill_in_middle,
        exactdedup.op13_exact_dedup,
    )
}

ORACLES: dict[str, str] = {
    "op4_exact_top_k": topk.ORACLE,
    "op9_quality_rules": hostrules.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_fill_in_middle": infill.ORACLE,
    "op13_exact_dedup": exactdedup.ORACLE,
}
