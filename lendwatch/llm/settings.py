"""Production parameters that several modules share."""

import public_tokenizers

from lendwatch.llm.packing import PackConfig

PACKING = PackConfig(
    tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
    ranks=(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
)
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
