"""New words reach the library in as few calls as their letters and punctuation allow, with the library's ids."""

import numpy as np

from cartwise.llm import queries as L
from cartwise.llm.tokens import WordIds


def test_punctuation_and_case_bring_no_new_words(monkeypatch):
    coder = WordIds(L.WORD_TOKENIZER)
    asked, learned = [], []
    library, stem = coder._library, coder._stem
    coder.tails.compute = lambda w: asked.append(w) or library(w)
    monkeypatch.setattr(coder, "_library", coder.tails.compute)
    coder.stems.compute = lambda s: learned.append(s) or stem(s)
    text = "Zorvab zorvab### ZORVAB,*** plimquet,### Plimquet)] été&&& Été"
    ids = coder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert asked == ["###", ",***", ",###", ")]", "&&&"]  # tails only
    assert learned == ["zorvab", "plimquet", "été"]


def test_odd_letters_and_tails_are_the_librarys():
    coder = WordIds(L.WORD_TOKENIZER)
    words = ["İstanbul", "Kelvin", "Ångström", "STRASSE", "Straẞe", "ΣΟΦΟΣ", "Ǆep.", "ŉa", "ⱾⱿ", "été!", "ﬁnd", "ªº", "don't", "o'", "we'll!!", "a_b_", "x_",
             "foo<|endoftext|>", "<|startoftext|>a", "a|>", "end<|", "a..'s", "a'.s", "3.5.", "a1#", "~", "日本語.", "각a", "A b#", "a​#", "zo" * 90 + "!?"]
    for word in [*words, " ".join(words), "\n".join(w.upper() for w in words), "# ".join(words)]:
        assert np.frombuffer(coder.encode(word), "<u4").tolist() == coder.tokenizer.encode(word, add_special_tokens=False).ids, word
