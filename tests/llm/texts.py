"""Made-up prose for the tests."""

import random

WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike "
         "november oscar papa quebec romeo sierra tango uniform victor whiskey xray").split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


BASE = "\n".join(prose(k, 40) for k in range(6))
NEAR = BASE.replace(BASE.split()[30], "changed", 1)
