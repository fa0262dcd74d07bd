from cardwarden.llm.quotations import link_quotations


def test_replies_follow_quotes(spark):
    rows = [
        (1, 0, "Hello there\nHow are you?"),
        (1, 1, "Something else"),
        (1, 2, ">  how ARE   you?\nFine."),
        (1, 3, ">> How are you?\n> Fine.\nGood to hear"),
        (1, 4, "> never written\nWhat?"),
        (2, 5, "> Fine.\nother conversation"),
        (1, None, "> Fine."),
        (None, 1, None),
    ]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, text string, depth int")
    found = {(r["conv_id"], r["turn"]): r for r in link_quotations(frame).collect()}
    assert len(found) == len(rows)
    get = lambda c, t, *names: tuple(found[c, t][n] for n in names)
    assert get(1, 2, "reply_to", "thread_turn", "depth", "plain_text") == (0, 0, 1, "Fine.")
    assert get(1, 3, "reply_to", "thread_turn", "depth", "levels", "linked") == (2, 0, 2, 2, 2)
    assert get(1, 4, "reply_to", "thread_turn", "depth", "quoted", "linked") == (None, 4, 0, 1, 0)
    assert get(2, 5, "reply_to", "plain_text") == (None, "other conversation")
    assert get(None, 1, "plain_text", "depth") == ("", 0)
    assert link_quotations(frame.limit(0)).collect() == []
