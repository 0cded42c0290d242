"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from tessella.llm.chat import OP3_SQL, op3_chat
from tessella.llm.decontaminate import op8_decontaminate
from tessella.llm.importance import op1_importance
from tessella.llm.jaccard_join import OP2_SQL, op2_jaccard_join
from tessella.llm.packing import op7_packing
from tessella.llm.sharding import OP6_SQL, op6_rendezvous
from tessella.llm.spotsigs import op10_spotsigs
from tessella.llm.token_files import op5_token_files
from tessella.llm.toxicity import op4_toxicity
from tessella.llm.url_filter import OP11_SQL, op11_url_filter
from tessella.llm.warc import OP9_SQL, op9_warc
from tessella.llm.whitening import op12_whitening


def queries() -> dict:
    return {
        "op1_importance": op1_importance,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_chat": op3_chat,
        "op4_toxicity": op4_toxicity,
        "op5_token_files": op5_token_files,
        "op6_rendezvous": op6_rendezvous,
        "op7_packing": op7_packing,
        "op8_decontaminate": op8_decontaminate,
        "op9_warc": op9_warc,
        "op10_spotsigs": op10_spotsigs,
        "op11_url_filter": op11_url_filter,
        "op12_whitening": op12_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": OP2_SQL, "op3_chat": OP3_SQL, "op6_rendezvous": OP6_SQL, "op9_warc": OP9_SQL, "op11_url_filter": OP11_SQL}
