import pytest

from gridmart.llm import quality_rules as Q

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            out, word = (out + [word] if word else out), ""
        else:
            word += c
    return out + [word] if word else out


def brute(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    marked = [False] * len(words)
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            marked[i : i + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    repeat = sum(marked)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat,
        "base_failed": len(words) < 10 or 100 * repeat > 20 * len(words),
    }


CASES = [
    None, "", " \n \n", "one two", "a b c d e " * 3, "a b c d e f a b c d e f", "x\ny\nx\n\n  \nx", "s #*$ | & <p> 100%\n" * 4,
    "the cat and the dog sat on the mat by the old oak tree in spring", "a b c d e", "a a a a a a", "a b c\x85d e f g",
]


def test_measures_equal_brute_force(make_docs):
    rows = {r.doc_id: r for r in Q.apply_rules(make_docs(list(enumerate(CASES)))).collect()}
    for i, text in enumerate(CASES):
        for name, value in brute(text).items():
            assert rows[i][name] == value, (text, name)


def test_long_text_in_which_everything_repeats(make_docs):
    row = Q.apply_rules(make_docs([(1, "la " * 20000)])).first()
    assert row.n_repeat_words == 20000 and row.base_failed and not row.kept


def test_verdict_is_the_conjunction_of_the_table(make_docs, documents):
    for r in Q.apply_rules(documents).collect():
        rules = [r[f"rule_{x.name}"] for x in Q.RULES]
        assert r.kept == (not r.base_failed and all(rules))


def test_thresholds_are_parameters(make_docs):
    docs = make_docs([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 # # #")])
    strict = (Q.Rule("few_symbols", "n_symbols", "n_words", most=0.1),)
    assert not Q.apply_rules(docs, strict).first().kept
    assert Q.apply_rules(docs, ()).first().kept


def test_filter_keeps_rows_columns_and_order_of_columns(odd_rows, make_docs, clashing):
    text = "the cat and the dog sat on a mat by the old oak"
    docs = clashing(make_docs([*odd_rows, (20, text), (20, text)]))
    kept = Q.keep_clean(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [20, 20]


def test_empty_table(make_docs):
    assert Q.apply_rules(make_docs([])).count() == 0


def test_no_python_and_no_exchange(documents):
    plan = Q.apply_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("rule", Q.RULES, ids=lambda r: r.name)
def test_every_rule_bites_on_something(rule, make_docs):
    bad = {
        "enough_words": "too few words",
        "word_length": "x" * 400 + " y" * 9,
        "few_symbols": "w# " * 12,
        "few_marks": "wow! " * 12,
        "has_stop_words": " ".join(f"zzq{i}x" for i in range(80)),
        "few_repeated_lines": "l1 a\nl1 a\nl1 a\nl2 b\nl1 a\nl1 a",
    }[rule.name]
    assert not Q.apply_rules(make_docs([(1, bad)])).first()[f"rule_{rule.name}"]
