"""A stand-in key-value store for the segmented-scan test: keys are spread
over segments by hash, as a real store's parallel scan would return them."""

import zlib


def scan_segment(segment, total, options):
    n = int(options.get("n", "100"))
    for i in range(n):
        key = f"app-{i}"
        if zlib.crc32(key.encode()) % total == segment:
            yield (key, f"uuid-{i}")
