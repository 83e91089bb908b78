"""The registered queries of this package, and the SQL of those that SQL can express."""

from shelfline.llm import decontaminate, fill_middle, jaccard_join, language, lm_score, minhash, packing, periodic, private_data, quality, secrets, suffix_dedup, topk

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_packing": packing.op2_packing,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_private_data": private_data.op5_private_data,
    "op6_language": language.op6_language,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_lm_score": lm_score.op8_lm_score,
    "op9_secrets": secrets.op9_secrets,
    "op10_topk": topk.op10_topk,
    "op11_periodic": periodic.op11_periodic,
    "op12_minhash": minhash.op12_minhash,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}

#: The others are fitted, tokenise, or follow links; they are tested against brute force.
ORACLES = {
    "op7_decontaminate": decontaminate.ORACLE,
    "op10_topk": topk.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
