"""A seeded log under five keys, and what the plain replay of the window rule
makes of it: window concat and upper case."""

import random

from .replay import replay

_random = random.Random(11)
INPUT = [(f"Key{_random.randrange(5)}", _random.choice("abcdefghijklmnopqrst"), i)
         for i in range(126)]

_WINDOWS = replay([(k, v, [i]) for k, v, i in INPUT], 3, 1)
VALUES = ["".join(_WINDOWS[k, (i,)][0]).upper() for k, _, i in INPUT]

#: The hashes of Key0 to Key4 are successive numbers, the first of them odd.
ODD = sum(k in ("Key0", "Key2", "Key4") for k, _, _ in INPUT)
