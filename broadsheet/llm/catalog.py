"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .article import op10_block_labeller
from .chat import OP5_SQL, op5_chat
from .langid import op12_kneser_ney
from .lines import OP3_SQL, op3_line_runs
from .manifest import OP13_SQL, op13_merkle_manifest
from .mixing import op6_temperature_mix
from .near import op2_order_minhash
from .negatives import OP11_SQL, op11_threshold_negatives
from .packing import op9_packed_tokens
from .phrases import OP8_SQL, op8_positional_index
from .quality import op7_quality_rules
from .sharding import op4_hypergeometric_shards
from .warc import OP1_SQL, op1_zip_warc

QUERIES = {
    "op1_zip_warc": op1_zip_warc,
    "op2_order_minhash": op2_order_minhash,
    "op3_line_runs": op3_line_runs,
    "op4_hypergeometric_shards": op4_hypergeometric_shards,
    "op5_chat": op5_chat,
    "op6_temperature_mix": op6_temperature_mix,
    "op7_quality_rules": op7_quality_rules,
    "op8_positional_index": op8_positional_index,
    "op9_packed_tokens": op9_packed_tokens,
    "op10_block_labeller": op10_block_labeller,
    "op11_threshold_negatives": op11_threshold_negatives,
    "op12_kneser_ney": op12_kneser_ney,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES = {
    "op1_zip_warc": OP1_SQL,
    "op3_line_runs": OP3_SQL,
    "op5_chat": OP5_SQL,
    "op8_positional_index": OP8_SQL,
    "op11_threshold_negatives": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
