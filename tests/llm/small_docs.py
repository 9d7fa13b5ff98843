"""Small documents for the tests of this folder."""

import random

WHITE = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(text):
    return [(line, line.strip(WHITE).translate(LOW)) for line in (text or "").split("\n")]


def words_of(text):
    return [w for w in (text or "").translate(str.maketrans(WHITE, " " * 6)).split(" ") if w]


def sample(n, seed=1):
    """Rows with copies, near copies, shared lines and passages."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(900)]
    passage = " ".join(r.choice(vocab) for _ in range(40))
    common = [" ".join(r.choice(vocab) for _ in range(6)).capitalize() for _ in range(6)]
    texts = []
    for i in range(n):
        kind = r.random()
        if texts and kind < 0.15:
            texts.append(r.choice(texts))
        elif texts and kind < 0.35:
            w = r.choice(texts).split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = r.choice(vocab)
            texts.append(" ".join(w))
        else:
            lines = [" ".join(r.choice(vocab) for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 9))]
            lines += [r.choice(common) + " " * r.randint(0, 2) for _ in range(r.randint(0, 2))]
            lines += [passage] * (r.random() < 0.2)
            r.shuffle(lines)
            texts.append("\n".join(lines))
    return [(i, t, ("en", "de", "fr", None)[i % 4], f"src{min(i % 7, 2)}", len(t)) for i, t in enumerate(texts)]
