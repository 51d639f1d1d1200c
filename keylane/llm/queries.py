"""The queries of this package over the stored tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from keylane.llm.bpe import op9_byte_bpe
from keylane.llm.filter_audit import op12_filter_audit
from keylane.llm.fingerprints import op2_document_fingerprints
from keylane.llm.language import op8_language_id
from keylane.llm.licenses import op6_license_scan
from keylane.llm.line_dedup import op3_line_dedup
from keylane.llm.mixing import op1_mix_sources
from keylane.llm.oracles import SQL
from keylane.llm.quality import op4_quality_rules
from keylane.llm.secret_scans import op7_secret_scan
from keylane.llm.sharding import op10_shard_by_bytes
from keylane.llm.simhash import op5_simhash_near_dedup
from keylane.llm.toxicity import op11_toxicity
from keylane.llm.vector_codes import op13_vector_codes

QUERIES = {f.__name__: f for f in (
    op1_mix_sources,
    op2_document_fingerprints,
    op3_line_dedup,
    op4_quality_rules,
    op5_simhash_near_dedup,
    op6_license_scan,
    op7_secret_scan,
    op8_language_id,
    op9_byte_bpe,
    op10_shard_by_bytes,
    op11_toxicity,
    op12_filter_audit,
    op13_vector_codes,
)}

__all__ = ["QUERIES", "SQL"]
