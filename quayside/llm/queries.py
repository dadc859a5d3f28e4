"""The queries of this subpackage, and SQL for those it can state; tests hold the others against brute force."""

from __future__ import annotations

from .binary import op5_binary
from .chat import op4_chat
from .collocations import OP13_SQL, op13_collocations
from .decontaminate import op10_decontaminate
from .fingerprints import op7_fingerprints
from .language import op6_language
from .licenses import op9_licenses
from .minhash import op8_minhash
from .packing import op3_packing
from .passages import OP11_SQL, op11_passages
from .sharding import op2_sharding
from .suffix import op1_suffix_dedup
from .whitening import op12_whitening

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_sharding, op3_packing, op4_chat, op5_binary, op6_language, op7_fingerprints, op8_minhash,
    op9_licenses, op10_decontaminate, op11_passages, op12_whitening, op13_collocations)}

SQL: dict[str, str] = {"op11_passages": OP11_SQL, "op13_collocations": OP13_SQL}
