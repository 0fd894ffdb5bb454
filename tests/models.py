"""Small plain-Python models that the Spark jobs are compared with."""

import csv
import io


def stable_sorted(pairs):
    return sorted(pairs, key=lambda p: p[0].lower())


def merge(existing, changelog):
    """Walk two sorted lists; equal folded titles pair up and the changelog row is taken."""
    e, c = stable_sorted(existing), stable_sorted(changelog)
    out, counts, i, j = [], {"updated_count": 0, "added_count": 0}, 0, 0
    while i < len(e) or j < len(c):
        left = e[i][0].lower() if i < len(e) else None
        right = c[j][0].lower() if j < len(c) else None
        if right is None or (left is not None and left < right):
            out.append(e[i])
            i += 1
            continue
        paired = left == right
        out.append(c[j])
        counts["updated_count" if paired else "added_count"] += 1
        i, j = i + paired, j + 1
    return out, counts | {"existing_count": len(e), "changelog_count": len(c), "total_count": len(out)}


def csv_bytes(pairs):
    """The dictionary file, and the ``(offset, length)`` of each row in it."""
    text = io.StringIO(newline="")
    writer = csv.writer(text)
    writer.writerow(("title", "value"))
    places, size = [], len(text.getvalue().encode())
    for pair in pairs:
        writer.writerow(pair)
        end = len(text.getvalue().encode())
        places.append((size, end - size))
        size = end
    return text.getvalue().encode(), places
