"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.op1_language_id import op1_language_id
from quayside.llm.op10_line_dedup import op10_line_dedup
from quayside.llm.op11_alignment import op11_alignment
from quayside.llm.op12_decontamination import op12_decontamination
from quayside.llm.op13_collocations import op13_collocations
from quayside.llm.op2_sentencepiece import op2_sentencepiece
from quayside.llm.op3_pii import op3_pii
from quayside.llm.op4_jaccard_join import op4_jaccard_join
from quayside.llm.op5_source_mix import op5_source_mix
from quayside.llm.op6_suffix_dedup import op6_suffix_dedup
from quayside.llm.op7_quality_rules import op7_quality_rules
from quayside.llm.op8_url_rules import op8_url_rules
from quayside.llm.op9_winnowing import op9_winnowing
from quayside.llm.oracles import ORACLES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language_id, op2_sentencepiece, op3_pii, op4_jaccard_join, op5_source_mix, op6_suffix_dedup,
        op7_quality_rules, op8_url_rules, op9_winnowing, op10_line_dedup,
        op11_alignment, op12_decontamination, op13_collocations,
    )
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
