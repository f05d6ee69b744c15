"""The queries of the operators and, where SQL can express them, the same in SQL."""

from shelfledger.llm.divergence import OP11_SQL, op11_divergence
from shelfledger.llm.fingerprints import op5_fingerprints
from shelfledger.llm.jaccard import OP10_SQL, op10_jaccard_join
from shelfledger.llm.languages import op7_languages
from shelfledger.llm.licenses import op3_licenses
from shelfledger.llm.line_runs import OP13_SQL, op13_line_dedup
from shelfledger.llm.mixing import op6_mixing
from shelfledger.llm.packing import op2_packing
from shelfledger.llm.personal import op1_personal_data
from shelfledger.llm.quality import op4_quality
from shelfledger.llm.secrets import OP8_SQL, op8_secrets
from shelfledger.llm.warc import op9_warc
from shelfledger.llm.whitening import op12_whitening

QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_fingerprints": op5_fingerprints,
    "op6_mixing": op6_mixing,
    "op7_languages": op7_languages,
    "op8_secrets": op8_secrets,
    "op9_warc": op9_warc,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_divergence": op11_divergence,
    "op12_whitening": op12_whitening,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE: dict[str, str] = {
    "op8_secrets": OP8_SQL,
    "op10_jaccard_join": OP10_SQL,
    "op11_divergence": OP11_SQL,
    "op13_line_dedup": OP13_SQL,
}
