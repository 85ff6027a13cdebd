"""The encoder against the library over every code point."""

import numpy as np

from lossmetrics.llm import bpe, queries


def test_every_code_point_next_to_letters():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        encoder = bpe.Encoder(bpe.Vocabulary(file.read()))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assigned_to = lambda c: f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}"
    wrong = []
    for start in range(0, len(points), 20_000):
        texts = [assigned_to(c) for c in points[start : start + 20_000]]
        ours = encoder.views(texts)["packed"]
        theirs = library.encode_batch(texts, add_special_tokens=False)
        wrong += [points[start + k] for k, (a, b) in enumerate(zip(ours, theirs)) if np.frombuffer(a, np.int32).tolist() != b.ids]
    assert [hex(c) for c in wrong] == []
