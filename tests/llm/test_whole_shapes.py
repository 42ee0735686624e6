from tessera.llm.quality import shape


def test_shape_of_a_long_token_has_its_end():
    assert shape("abc" * 40 + "-7/9") == "x-9/9"
    assert shape("字" * 100 + "。Ab1") == "x。Xx9"
    assert shape("a1" * 60 + "-B") == "x9x9~9-Xx"
