"""Made-up texts for the tests."""

WORDS = "the river runs under a stone bridge and every morning an old miller walks along its bank to count grey herons near deep water".split()


def prose(seed: int, n: int, extra: str = "") -> str:
    """``n`` words that hardly repeat in order, different for each seed."""
    state, out = seed * 7919 + 13, []
    for i in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 65536 % len(WORDS)] + (str(state % 89) if i % 3 == 0 else ""))
    return " ".join(out) + extra
