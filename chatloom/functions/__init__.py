from .clock import now_ms
from .lexicon import WORD_CHAR, mask_literal, word_pattern

__all__ = ["WORD_CHAR", "mask_literal", "now_ms", "word_pattern"]
