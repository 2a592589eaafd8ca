import random

import pytest

from furniture_lines import FURNITURE, PROSE, TITLES
from trailgrain.llm import boilerplate


def judged(lang: str, with_title: bool = True):
    """(furniture lines found, all, prose lines taken for furniture, all) of pages that mix both."""
    rng, blocks = random.Random(lang), boilerplate.Blocks()
    found = wrong = total = clean = 0
    lines = FURNITURE[lang].splitlines()
    for i in range(0, len(lines), 4):
        page = [(s, False) for s in PROSE[lang]]
        page.insert(0, (TITLES[lang], False))
        for line in lines[i : i + 4]:
            page.insert(rng.choice([0, *range(2, len(page) + 1)]), (line, True))
        got = blocks.lines("\n".join(s for s, _ in page), "oat-pot3.example", None, TITLES[lang] if with_title else None)
        for (_, is_furniture), f in zip(page, got, strict=True):
            total, clean = total + is_furniture, clean + (not is_furniture)
            found, wrong = found + (f and is_furniture), wrong + (f and not is_furniture)
    return found, total, wrong, clean


def test_unlisted_furniture_is_told_by_density():
    counts = {lang: judged(lang) for lang in FURNITURE}
    found, total, wrong, clean = (sum(c[i] for c in counts.values()) for i in range(4))
    print(counts)
    assert total == 240 and found >= 0.9 * total and wrong <= 0.01 * clean and all(c[0] >= 15 for c in counts.values())


def test_without_a_title_the_headline_is_known_by_its_place():
    counts = [judged(lang, False) for lang in FURNITURE]
    assert sum(c[0] for c in counts) >= 0.8 * 240 and sum(c[2] for c in counts) <= 0.05 * sum(c[3] for c in counts)


def test_the_lists_have_none_of_these_lines():
    rules = boilerplate._rules()
    unlisted = [line for lines in FURNITURE.values() for line in lines.splitlines()]
    known = [s for s in unlisted if rules.anchors.fullmatch(s.lower()) or boilerplate.notice_cover(s.lower()) >= boilerplate.NOTICE_COVER]
    assert known == []


def test_density_falls_with_links_and_sums_choose_the_body():
    free, some, all_links = (boilerplate.composite(100, 4, n, k, 0.2) for n, k in ((0, 0), (50, 2), (100, 4)))
    assert free > some > all_links == 0
    assert boilerplate.composite(0, 1, 0, 0, 0) == 0
    page = ["Home | Recipes", "Stir the beans.", "Log in / Search", "Bring the water to a boil and add the beans, then wait for ten minutes.", "Serve them hot."]
    assert boilerplate.Blocks().lines("\n".join(page), None, None) == [True, False, True, False, False]


@pytest.mark.parametrize("times", [1, 12])
def test_a_notice_is_found_however_long(times):
    notice = " ".join(["We use cookies to improve your visit. Accept all"] * times)
    page = ["Stir the beans.", notice, "Serve them hot and share them with whoever is still awake in the other tents of the camp, as there is always more than two people can eat, even hungry ones."]
    assert boilerplate.Blocks().lines("\n".join(page), None, None) == [False, True, False]


@pytest.mark.parametrize("lines", [["Page not found"], ["asdf asdf asdf"], ["{{ title }}"], ["", " "], ["Boil the rice"]])
def test_pages_without_sentences_stay(lines):
    assert not any(boilerplate.Blocks().lines("\n".join(lines), None, None))
