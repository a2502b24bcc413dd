"""The corpus queries and their SQL, by name."""

from __future__ import annotations

from . import bpe, exact_dedup, html_extract, jaccard, licenses, lm_score, packing, quality, secrets, warc

QUERIES = {
    "op1_lm_score": lm_score.op1_lm_score,
    "op2_warc": warc.op2_warc,
    "op3_licenses": licenses.op3_licenses,
    "op4_html": html_extract.op4_html,
    "op5_packing": packing.op5_packing,
    "op6_bpe": bpe.op6_bpe,
    "op7_jaccard": jaccard.op7_jaccard,
    "op8_secrets": secrets.op8_secrets,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_quality": quality.op10_quality,
}
SQL = {"op2_warc": warc.OP2_SQL, "op7_jaccard": jaccard.OP7_SQL, "op9_exact_dedup": exact_dedup.OP9_SQL, "op10_quality": quality.OP10_SQL}
