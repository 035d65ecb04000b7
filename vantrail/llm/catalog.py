"""The numbered queries and the pipeline, with the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from vantrail.llm.exact import OP5_SQL, op5_exact_dedup
from vantrail.llm.extraction import op1_main_text
from vantrail.llm.identifiers import op10_identifiers
from vantrail.llm.jaccard import op4_jaccard_join
from vantrail.llm.languages import op7_language
from vantrail.llm.mixing import OP9_SQL, op9_mixing
from vantrail.llm.multiset import op8_fingerprints
from vantrail.llm.packing import op3_packing
from vantrail.llm.phrases import OP12_SQL, op12_collocations
from vantrail.llm.repeats import op6_repeats
from vantrail.llm.secret_scan import op2_secrets
from vantrail.llm.spelling import op11_spelling
from vantrail.llm.superminhash import op13_superminhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_repeats": op6_repeats,
    "op7_language": op7_language,
    "op8_fingerprints": op8_fingerprints,
    "op9_mixing": op9_mixing,
    "op10_identifiers": op10_identifiers,
    "op11_spelling": op11_spelling,
    "op12_collocations": op12_collocations,
    "op13_superminhash": op13_superminhash,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op5_exact_dedup": OP5_SQL,
    "op9_mixing": OP9_SQL,
    "op12_collocations": OP12_SQL,
}
