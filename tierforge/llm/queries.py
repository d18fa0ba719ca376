"""The operators as queries over the whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from tierforge.llm.decontamination import OP6_SQL, op6_benchmark_decontamination
from tierforge.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from tierforge.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tierforge.llm.html_extraction import op10_html_extraction
from tierforge.llm.language_id import op1_language_id
from tierforge.llm.license_scan import op7_license_scan
from tierforge.llm.packing import op3_vector_packing
from tierforge.llm.quality_rules import op9_quality_rules
from tierforge.llm.secret_scan import op8_secret_scan
from tierforge.llm.simhash import op5_simhash_near_dedup
from tierforge.llm.suffix_dedup import op2_suffix_dedup
from tierforge.llm.tokenizer_alignment import op12_tokenizer_alignment
from tierforge.llm.toxicity import op13_toxicity

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_vector_packing": op3_vector_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_html_extraction": op10_html_extraction,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_toxicity": op13_toxicity,
}

ORACLES = {
    "op4_exact_dedup": OP4_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op11_hard_negatives": OP11_SQL,
}
