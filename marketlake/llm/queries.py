"""The registered query of every operator, and SQL where it can express one."""

from __future__ import annotations

from marketlake.llm.decontaminate import op4_decontaminate
from marketlake.llm.katz import op8_katz
from marketlake.llm.langid import op3_langid
from marketlake.llm.licenses import OP13_SQL, op13_licenses
from marketlake.llm.merkle import OP11_SQL, op11_merkle
from marketlake.llm.mixing import op7_mixing
from marketlake.llm.prefixes import OP12_SQL, op12_prefixes
from marketlake.llm.repeats import OP6_SQL, op6_repeats
from marketlake.llm.secrets import op10_secrets
from marketlake.llm.sharding import op5_sharding
from marketlake.llm.simhash import op2_simhash
from marketlake.llm.tokencounts import op9_token_counts
from marketlake.llm.vafile import OP1_SQL, op1_vafile
from marketlake.session import prepare


def _prepared(query):
    return lambda spark, folder: query(prepare(spark), folder)


QUERIES = {q.__name__: _prepared(q) for q in (op1_vafile, op2_simhash, op3_langid, op4_decontaminate, op5_sharding, op6_repeats, op7_mixing, op8_katz,
                                                 op9_token_counts, op10_secrets, op11_merkle, op12_prefixes, op13_licenses)}
ORACLES = {"op1_vafile": OP1_SQL, "op6_repeats": OP6_SQL, "op11_merkle": OP11_SQL, "op12_prefixes": OP12_SQL, "op13_licenses": OP13_SQL}
