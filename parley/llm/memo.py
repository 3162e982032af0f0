"""A bounded memory of answers for use inside a task."""


class Memo(dict):
    """key -> answer(key), by looking the key up. When it is full it becomes the older generation, and what
    is asked for again comes back from there, so frequent keys stay and one-off keys go."""

    def __init__(self, answer, size: int, keep=None):
        super().__init__()
        self.answer, self.size, self.keep, self.older = answer, size, keep, {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.answer(key)
            if self.keep and not self.keep(key):
                return got
        self.put(key, got)
        return got

    def kept(self, keys: list) -> list:
        """The answers that either generation has; null for others. What comes from the older one is young again."""
        out, older = list(map(self.get, keys)), self.older
        for i, got in enumerate(out):
            if got is None and (got := older.get(keys[i])) is not None:
                out[i] = got
                self.put(keys[i], got)
        return out

    def put(self, key, got) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = got
