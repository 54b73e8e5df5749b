"""A feed over a text file of rows for the stream source's test: region, timestamp, key."""


class Feed:
    def __init__(self, options):
        self.path = options["rows"]

    def _rows(self):
        with open(self.path) as f:
            return sorted(tuple(map(int, line.split())) for line in f if line.strip())

    def regions(self):
        return sorted({r for r, _, _ in self._rows()})

    def ready(self, region, after):
        return [(ts, 1024) for r, ts, _ in self._rows() if r == region and ts > after]

    def entries(self, region, after, upto):
        for r, ts, key in self._rows():
            if r == region and after < ts <= upto:
                yield ts, r, "COMMITTED", "PUT", f"k{key}", ts, ts, f"v{key}", None


def factory(options):
    return Feed(options)
