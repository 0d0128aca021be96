"""Record-by-record replay of the window rule, for comparison."""


def replay(rows, size, slide):
    """(key, value, ord) in any order -> {(key, ord): (window, evicted, prior)}"""
    windows, out = {}, {}
    for key, value, order in sorted(rows, key=lambda r: r[2]):
        prior = windows.get(key, [])
        full = len(prior) == size
        window = prior + [value]
        evicted = window[:slide] if full else []
        window = window[slide:] if full else window
        windows[key] = window
        out[key, tuple(order)] = (window, evicted, prior)
    return out


def collected(df):
    return {(r["key"], tuple(r["ord"])): (list(r["window"]), list(r["evicted"]),
                                         list(r["prior"]))
            for r in df.collect()}
