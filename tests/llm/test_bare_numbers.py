from __future__ import annotations

from tidewater.llm import secrets


def found(text, automaton=secrets._automaton(secrets.RULES)):
    return [(rule, secret.decode()) for rule, _, secret, checked in secrets.scan(text.encode(), automaton) if checked]


def test_cards_without_a_word_before_them():
    for card in ("4845168114407329", "4111 1111 1111 1111", "4012-8888-8888-1881", "5555555555554444", "378282246310005", "3782 822463 10005", "30569309025904", "6011111111111117", "2223003122003222", "4222222222222"):
        assert found(f"les, {card} enlé") == found(f"é\n{card}") == found(f"é{card}.") == [("card_number", card)], card
    assert found("7536784127813050 4845168114407329 7536784127813050") == [("card_number", "4845168114407329")]
    assert found("4111 1111 1111 1111 123 times") == [("card_number", "4111 1111 1111 1111")]


def test_numbers_that_are_no_cards():
    for text in ("4845168114407328", "4111 1111 1111 1112", "7536784127813050", "0.4845168114407329", "a4845168114407329", "14845168114407329000000", "48451681144073295555555", "4444 4444 4444 4444"):
        assert found(text) == [], text


def test_accounts_without_a_word_before_them():
    for account in ("DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947", "FR1420041010050500013M02606", "BE68 5390 0754 7034"):
        assert found(f"é {account}, now") == [("bank_account", account)], account
    assert found("to DE88370400440532013000 or DE8937040044053201300 or XDE89370400440532013000") == []
