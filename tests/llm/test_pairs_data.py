def joined(rnd, n):
    return " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
