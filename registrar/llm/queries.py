"""The registered queries of this package and their SQL."""

from __future__ import annotations

from registrar.llm import (
    bpe, chunks, codes, decontaminate, jaccard, langid, licenses, quality, registers, rules, spelling, suffixes, urls,
)
from registrar.llm.common import ship_package


def _ready(query):
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_decontamination": decontaminate.query,
    "op2_language_id": langid.query,
    "op3_bpe": bpe.query,
    "op4_license_scan": licenses.query,
    "op5_substring_dedup": chunks.query,
    "op6_quality_rules": rules.query,
    "op7_quality_ranking": quality.query,
    "op8_suffix_dedup": suffixes.query,
    "op9_url_filter": urls.query,
    "op10_jaccard_join": jaccard.query,
    "op11_minhash_registers": registers.query,
    "op12_spelling_variants": spelling.query,
    "op13_vector_codes": codes.query,
}
QUERIES = {name: _ready(query) for name, query in _QUERIES.items()}
SQL = {
    "op1_decontamination": decontaminate.SQL,
    "op4_license_scan": licenses.SQL,
    "op6_quality_rules": rules.SQL,
    "op9_url_filter": urls.SQL,
    "op10_jaccard_join": jaccard.SQL,
    "op11_minhash_registers": registers.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_vector_codes": codes.SQL,
}
