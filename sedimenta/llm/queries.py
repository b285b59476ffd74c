"""The registered queries of this subpackage."""

from __future__ import annotations

from . import oracles
from .op1_quality import op1_quality
from .op2_repeated_bytes import op2_repeated_bytes
from .op3_neighbours import op3_neighbours
from .op4_mixing import op4_mixing
from .op5_jaccard_join import op5_jaccard_join
from .op6_divergence import op6_divergence
from .op7_token_files import op7_token_files
from .op8_pseudo_likelihood import op8_pseudo_likelihood
from .op9_sentencepiece import op9_sentencepiece
from .op10_toxicity import op10_toxicity
from .op11_alignment import op11_alignment
from .op12_minmax import op12_minmax
from .op13_spellings import op13_spellings

QUERIES = {f.__name__: f for f in (
    op1_quality, op2_repeated_bytes, op3_neighbours, op4_mixing, op5_jaccard_join, op6_divergence, op7_token_files,
    op8_pseudo_likelihood, op9_sentencepiece, op10_toxicity, op11_alignment, op12_minmax, op13_spellings)}
ORACLES: dict[str, str] = {
    "op5_jaccard_join": oracles.OP5, "op12_minmax": oracles.OP12, "op13_spellings": oracles.OP13}
