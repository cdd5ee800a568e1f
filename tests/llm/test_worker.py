"""Objects that workers keep."""

from rillflow.llm.worker import kept


def test_large_objects_go_when_others_are_asked_for():
    made = []

    def make(name):
        return lambda: made.append(name) or [name]

    small = kept(("small test",), make("small"))
    first = kept(("large test",), make("first"), large=True)
    assert kept(("large test",), make("again"), large=True) is first
    assert kept(("small test",), make("never")) is small
    assert kept(("large test",), make("second"), large=True) is not first
    assert kept(("other test",), make("third"), large=True) == ["third"]
    kept(("small test",), make("never"))
    assert made == ["small", "first", "second", "third"]
