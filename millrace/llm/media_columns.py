"""Media columns: each text's bytes as a progressive JPEG file, read back to a full-resolution tensor.

Every whole text (null: empty) is taken as UTF-8, padded with zero bytes to a positive
multiple of 64 and stored in the coefficients of a progressive file, which is lossless
where samples aren't. The stored bytes are then decoded: scans accumulate in coefficient
arrays, these give back the payload and, inverse-transformed and with chroma upsampled,
an RGB tensor, whose statistics are the feature. Equal texts give equal values throughout.

Work memory is that of one text's file at a time. An empty table gives an empty result;
other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import progressive_jpeg as jpeg
from millrace.llm.batches import map_batches


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % jpeg.BLOCK if raw else jpeg.BLOCK)


def feature_of(rgb: np.ndarray) -> str:
    """Size, and mean and mean square of each channel in thousandths, all from exact integer sums."""
    flat = rgb.reshape(-1, 3)
    counts = [np.bincount(flat[:, k], minlength=256) for k in range(3)]
    level, n = np.arange(256), len(flat)
    mean = [int(c @ level) * 1000 // n for c in counts]
    square = [int(c @ (level * level)) * 1000 // n for c in counts]
    return f"{rgb.shape[0]}x{rgb.shape[1]};mean={','.join(map(str, mean))};square={','.join(map(str, square))}"


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", tensors: bool = True) -> DataFrame:
    """Rows (key, n_bytes, payload, media, height, width, feature, and with ``tensors`` rgb in row-major order).

    ``payload`` is what the stored file gives back.
    """

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: list[list] = [[] for _ in range(7)]
            for t in batch.column(1).to_pylist():
                media = jpeg.encode_payload(payload_of(t))
                image = jpeg.decode(media)
                rgb = jpeg.to_rgb(image)
                for column, value in zip(rows, (len((t or "").encode()), jpeg.read_payload(image), media, image.height, image.width, feature_of(rgb), rgb.tobytes() if tensors else None), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.string(), pa.binary())
            arrays = [pa.array(r, kind) for r, kind in zip(rows, kinds, strict=True)]
            names = ["n_bytes", "payload", "media", "height", "width", "feature", "rgb"]
            n = 7 if tensors else 6
            return pa.RecordBatch.from_arrays([batch.column(0), *arrays[:n]], names=[key, *names[:n]])

        return work

    return map_batches(docs.select(key, text), make, f"`{key}` {dict(docs.dtypes)[key]}, n_bytes long, payload binary, media binary, height int, width int, feature string" + ", rgb binary" * tensors)
