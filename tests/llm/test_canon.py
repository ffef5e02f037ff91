import random
from itertools import permutations

from marquee.llm import canon


def test_best_assignment():
    rnd = random.Random(4)
    for _ in range(60):
        rows = rnd.randrange(1, 5)
        columns = rnd.randrange(rows, 6)
        worth = [[float(rnd.choice([0, 0, 1, 3, 5, 8])) for _ in range(columns)] for _ in range(rows)]
        want = max(sum(worth[i][c] for i, c in enumerate(order)) for order in permutations(range(columns), rows))
        assert canon.best_assignment(worth) == want


def test_assigned():
    assert canon.assigned(("high", "low"), ("low", "high")) == 1.0 and canon.assigned((), ("a",)) == 0.0
    assert canon.assigned(("tannery",), ("tannry",)) > 0.8 and canon.assigned(("4th",), ("5th",)) == 0.0
    many = tuple(f"word{'abcdefghij'[i]}" for i in range(10))
    assert canon.assigned(many, many[::-1]) == 1.0


def test_edits():
    assert [canon.edits(a, b, 2) for a, b in (("ab", "ba"), ("abc", "abc"), ("abc", "ab"), ("abcd", "badc"), ("abc", "xyz"))] == [1, 0, 1, 2, 3]


def test_forms():
    same = lambda f, *texts: len({f(t) for t in texts}) == 1
    assert same(lambda t: canon.name_parts(t)[:3], "The Sample Players Guild dba Sample Players", "SAMPLE PLYRS, LLC", "Players of Sample")
    assert same(canon.locality, "Ft. Sample", "Fort Sample") and canon.locality(None) == ""
    assert canon.title_parts("A Show JR.") != canon.title_parts("A Show") == canon.title_parts("the show!")
    assert canon.address_parts("Hall, Low Road, No. 12 Ste 4")[:4] == ("street", "12", "low", "road") and canon.address_parts(None)[0] == ""
