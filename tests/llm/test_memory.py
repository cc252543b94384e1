from tillroll.llm.memory import Memory


class Unwalked(dict):
    """Can be asked for a key, but not walked through."""

    def __iter__(self):
        raise AssertionError("the whole memory was walked through")


def test_a_fill_costs_its_own_words_only():
    made = []
    memory = Memory(lambda words: [made.append(w) or w.upper() for w in words], most=3)
    memory.old = Unwalked(a="A", b="B", c="C")
    assert list(map(memory.fill({"a", "x"}), ["a", "x"])) == ["A", "X"]
    assert list(map(memory.fill({"b", "x", "y"}), ["b", "x", "y"])) == ["B", "X", "Y"]
    assert made == ["x", "y"] and "c" not in memory.now
