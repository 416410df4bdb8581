from cellweave.llm import archives


def test_page_ids_of_19_digits_are_kept():
    assert archives._number(str(2 ** 63 - 1)) == 2 ** 63 - 1
    assert archives._number(str(-2 ** 63)) == -2 ** 63
    assert archives._number("12") == 12
    for text in (str(2 ** 63), str(-2 ** 63 - 1), "1" * 20, "", None, "1x"):
        assert archives._number(text) is None
