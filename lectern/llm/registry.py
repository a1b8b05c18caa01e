"""The queries of this subpackage by name, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from lectern.llm import hard_negatives, sort_means
from lectern.llm.byte_bpe import op13_byte_bpe
from lectern.llm.contamination import op5_benchmark_decontamination
from lectern.llm.fingerprints import op7_syncmer_fingerprints
from lectern.llm.licenses import op3_license_scan
from lectern.llm.near_dup import op1_minhash_near_dedup
from lectern.llm.packing import op10_best_fit_packing
from lectern.llm.pages import op9_wrapper_induction
from lectern.llm.personal_data import op4_personal_data
from lectern.llm.quality import op8_quality_knn
from lectern.llm.secrets import op6_secret_scan
from lectern.llm.shards import op2_balanced_shards

QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup,
    op2_balanced_shards,
    op3_license_scan,
    op4_personal_data,
    op5_benchmark_decontamination,
    op6_secret_scan,
    op7_syncmer_fingerprints,
    op8_quality_knn,
    op9_wrapper_induction,
    op10_best_fit_packing,
    hard_negatives.op11_quantised_negatives,
    sort_means.op12_sort_means,
    op13_byte_bpe,
)}
ORACLES: dict[str, str] = {"op11_quantised_negatives": hard_negatives.SQL, "op12_sort_means": sort_means.SQL}
