"""Small images and slow, plain reference computations for them."""

import numpy as np

IMAGES = "image_id long, height int, width int, n_channels int, data binary"


def image_table(spark, arrays):
    rows = []
    for i, a in enumerate(arrays):
        channels = 1 if a.ndim == 2 else a.shape[2]
        rows.append((i, a.shape[0], a.shape[1], channels, bytearray(a.astype(np.uint8).tobytes())))
    return spark.createDataFrame(rows, IMAGES)


def rebuild(bands, channels=1):
    """Images from bands, as {image_id: array}."""
    out = {}
    for row in bands.collect():
        held = np.frombuffer(bytes(row.data), np.uint8).reshape(row.e1 - row.e0, row.width, channels)
        core = held[row.y0 - row.e0 : row.y1 - row.e0]
        image = out.setdefault(row.image_id, np.full((row.height, row.width, channels), 99, np.uint8))
        image[row.y0 : row.y1] = core
    return {k: v[..., 0] if channels == 1 else v for k, v in out.items()}


def flood(mask, diagonal):
    """Label image (0 = none) by plain flood fill."""
    h, w = mask.shape
    near = [(-1, 0), (1, 0), (0, -1), (0, 1)]
    if diagonal:
        near += [(-1, -1), (-1, 1), (1, -1), (1, 1)]
    labels = np.zeros((h, w), int)
    n = 0
    for y in range(h):
        for x in range(w):
            if mask[y, x] and not labels[y, x]:
                n += 1
                stack = [(y, x)]
                labels[y, x] = n
                while stack:
                    cy, cx = stack.pop()
                    for dy, dx in near:
                        ny, nx = cy + dy, cx + dx
                        if 0 <= ny < h and 0 <= nx < w and mask[ny, nx] and not labels[ny, nx]:
                            labels[ny, nx] = n
                            stack.append((ny, nx))
    return labels


def filled(mask):
    """Holes filled by flooding the background from the frame."""
    labels = flood(mask == 0, diagonal=False)
    frame = set(labels[0]) | set(labels[-1]) | set(labels[:, 0]) | set(labels[:, -1])
    outside = np.isin(labels, [v for v in frame if v])
    return ((mask != 0) | ((labels > 0) & ~outside)).astype(np.uint8)


def areas(mask):
    """{first pixel: contour area} with the 2x2 window rule."""
    labels = flood(mask, diagonal=True)
    h, w = mask.shape
    out = {}
    for label in range(1, labels.max() + 1):
        m = labels == label
        first = int(np.flatnonzero(m.ravel())[0])
        area = 0.0
        for y in range(h - 1):
            for x in range(w - 1):
                n = m[y : y + 2, x : x + 2].sum()
                area += 1.0 if n == 4 else 0.5 if n == 3 else 0.0
        out[first] = area
    return out


def spiral(size):
    """A one-pixel-wide spiral: one component that crosses every band many times."""
    m = np.zeros((size, size), np.uint8)
    y = x = 0
    dy, dx = 0, 1
    m[0, 0] = 1
    left, top, right, bottom = 0, 0, size - 1, size - 1
    while left <= right and top <= bottom:
        m[top, left : right + 1] = 1
        m[top : bottom + 1, right] = 1
        m[bottom, left + 0 : right + 1] = 1
        if top + 2 <= bottom:
            m[top + 2 : bottom + 1, left] = 1
            if left + 1 <= right:
                m[top + 2, left : left + 2] = 1
        left, top, right, bottom = left + 2, top + 2, right - 2, bottom - 2
    return m


def shuffled_bytes(df):
    """Bytes of rows that each shuffle of a finished query took, as Spark counted them."""
    sizes = []

    def walk(node):
        name = node.nodeName()
        if name == "Exchange":
            sizes.append(node.metrics().apply("dataSize").value())
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if name.endswith("QueryStage") else None
        if inner is not None:
            walk(inner)
        below = node.children()
        for i in range(below.size()):
            walk(below.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sizes
