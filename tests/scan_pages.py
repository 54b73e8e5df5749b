"""A store of 100 keys in two regions, for the key range source."""

KEYS = [f"k{i:03d}".encode() for i in range(100)]


def factory(region):
    def pages(start, n):
        end = b"k050" if start < b"k050" else b""
        inside = [k for k in KEYS if k >= start and (not end or k < end)]
        return [(k, b"v" + k) for k in inside[:n]], end

    return pages
