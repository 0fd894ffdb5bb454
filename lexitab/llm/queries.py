"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from lexitab.llm.byte_bpe import op7_byte_bpe
from lexitab.llm.decontamination import OP9_SQL, op9_decontamination
from lexitab.llm.embeddings import OP3_SQL, op3_embeddings
from lexitab.llm.filter_audit import OP11_SQL, op11_filter_audit
from lexitab.llm.language import op8_language
from lexitab.llm.licenses import OP1_SQL, op1_licenses
from lexitab.llm.packing import op12_packing
from lexitab.llm.quality import op10_quality
from lexitab.llm.sharding import OP2_SQL, op2_sharding
from lexitab.llm.simhash import op6_simhash
from lexitab.llm.token_counts import op5_token_counts
from lexitab.llm.token_files import op4_token_files
from lexitab.llm.vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {f.__name__: f for f in (
    op1_licenses, op2_sharding, op3_embeddings, op4_token_files, op5_token_counts, op6_simhash, op7_byte_bpe,
    op8_language, op9_decontamination, op10_quality, op11_filter_audit,
    op12_packing, op13_vector_codes)}

ORACLES = {"op1_licenses": OP1_SQL, "op2_sharding": OP2_SQL, "op3_embeddings": OP3_SQL, "op9_decontamination": OP9_SQL,
           "op11_filter_audit": OP11_SQL, "op13_vector_codes": OP13_SQL}
