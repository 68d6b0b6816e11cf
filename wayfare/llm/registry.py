"""The registered queries of the training-data operators, and their SQL."""

from wayfare.llm import fingerprints, hardnegatives, hosts, jaccard, kneser_ney, language, licences, mixing, packing, quality_rules, tokencounts, tokenfiles, whitening

QUERIES = {
    "op1_kneser_ney": kneser_ney.op1_kneser_ney,
    "op2_mixing": mixing.op2_mixing,
    "op3_packing": packing.op3_packing,
    "op4_quality": quality_rules.op4_quality,
    "op5_language": language.op5_language,
    "op6_licences": licences.op6_licences,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_token_counts": tokencounts.op8_token_counts,
    "op9_jaccard": jaccard.op9_jaccard,
    "op10_hosts": hosts.op10_hosts,
    "op11_whitening": whitening.op11_whitening,
    "op12_hard_negatives": hardnegatives.op12_hard_negatives,
    "op13_token_files": tokenfiles.op13_token_files,
}
SQL = {
    "op2_mixing": mixing.OP2_SQL,
    "op9_jaccard": jaccard.OP9_SQL,
    "op10_hosts": hosts.sql(),
    "op12_hard_negatives": hardnegatives.OP12_SQL,
}
