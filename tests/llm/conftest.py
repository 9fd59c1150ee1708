import base64

import pytest


@pytest.fixture(scope="session")
def library():
    """The public library with the rank file of the BPE query."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(autouse=True)
def _no_runs_left(request):
    """A test that keeps its runs of lines leaves their tables to the session; those that follow look for their own."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for left in session.catalog.listTables():
            if left.name.startswith("line_run_"):
                session.sql(f"DROP TABLE {left.name}")
