def prose(seed, n):
    import random
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 6))) for _ in range(n))
