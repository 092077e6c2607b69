"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from tesselar.llm.collocations import OP12_SQL, op12_collocations
from tesselar.llm.decontamination import OP10_SQL, op10_decontaminate
from tesselar.llm.html_extraction import op9_html_extraction
from tesselar.llm.near_duplicates import op6_ngram_join
from tesselar.llm.packing import op4_best_fit_packing
from tesselar.llm.quality_model import op8_quality
from tesselar.llm.quality_rules import OP2_SQL, op2_quality_rules
from tesselar.llm.quotations import OP5_SQL, op5_quotation_links
from tesselar.llm.source_divergence import OP13_SQL, op13_source_divergence
from tesselar.llm.token_files import op3_token_files
from tesselar.llm.toxicity import op7_toxicity
from tesselar.llm.url_lists import OP1_SQL, op1_url_lists
from tesselar.llm.vector_links import op11_vector_links

QUERIES = {
    "op1_url_lists": op1_url_lists,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_files": op3_token_files,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quotation_links": op5_quotation_links,
    "op6_ngram_join": op6_ngram_join,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_html_extraction": op9_html_extraction,
    "op10_decontaminate": op10_decontaminate,
    "op11_vector_links": op11_vector_links,
    "op12_collocations": op12_collocations,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE = {
    "op1_url_lists": OP1_SQL,
    "op2_quality_rules": OP2_SQL,
    "op5_quotation_links": OP5_SQL,
    "op10_decontaminate": OP10_SQL,
    "op12_collocations": op12_collocations,
    "op12_collocations": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
