import os

import pytest


@pytest.fixture(scope="session")
def tokens_dir():
    from quillstone.llm.tokens import RANKS, TOKENIZERS

    if not os.path.exists(os.path.join(TOKENIZERS, RANKS)):
        pytest.skip("no tokenizer files")
    return TOKENIZERS
