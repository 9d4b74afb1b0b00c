"""Text without spaces."""

from spillway.llm import toxicity


def test_long_runs_are_read_whole():
    run = "".join(chr(0x4E00 + i) for i in range(200)).encode()
    found = toxicity.words(b"ab " + run + b" " + b"c" * 64)
    assert found[0] == b"ab" and found[-1] == b"c" * 64 and all(len(w) <= 64 and w.decode() for w in found)
    grams = lambda w: {w[k : k + 4] for k in range(len(w) - 3)}
    assert set().union(*map(grams, found[1:-1])) == grams(run)
