"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from ledgerflow.llm.centroids import OP12_SQL, op12_threshold
from ledgerflow.llm.chat_windows import OP11_SQL, op11_windows
from ledgerflow.llm.decontamination import OP3_SQL, op3_winnowing
from ledgerflow.llm.filter_audit import OP13_SQL, op13_folds
from ledgerflow.llm.language_id import op10_mixture
from ledgerflow.llm.maxent_lm import op4_maxent
from ledgerflow.llm.near_dedup import OP8_SQL, op8_hyperminhash
from ledgerflow.llm.packing import op5_differencing
from ledgerflow.llm.quality import op9_nnpu
from ledgerflow.llm.repair_tokens import op1_repair
from ledgerflow.llm.substring_dedup import OP7_SQL, op7_doubling
from ledgerflow.llm.topk_search import OP6_SQL, op6_threshold
from ledgerflow.llm.url_filter import OP2_SQL, op2_rarest_token

QUERIES = {
    "op1_repair": op1_repair,
    "op2_rarest_token": op2_rarest_token,
    "op3_winnowing": op3_winnowing,
    "op4_maxent": op4_maxent,
    "op5_differencing": op5_differencing,
    "op6_threshold": op6_threshold,
    "op7_doubling": op7_doubling,
    "op8_hyperminhash": op8_hyperminhash,
    "op9_nnpu": op9_nnpu,
    "op10_mixture": op10_mixture,
    "op11_windows": op11_windows,
    "op12_threshold": op12_threshold,
    "op13_folds": op13_folds,
}
ORACLES = {
    "op2_rarest_token": OP2_SQL,
    "op3_winnowing": OP3_SQL,
    "op6_threshold": OP6_SQL,
    "op7_doubling": OP7_SQL,
    "op8_hyperminhash": OP8_SQL,
    "op11_windows": OP11_SQL,
    "op12_threshold": OP12_SQL,
    "op13_folds": OP13_SQL,
}
