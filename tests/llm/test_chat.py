import random

from varloom.llm import chat


def tree(messages):
    """Best path of each tree by hand."""
    known = {}
    for t, i, p, role, text, score in messages:
        known.setdefault(t, {})[i] = (p, role or "", text or "", score or 0.0)
    out = {}
    for t, nodes in known.items():
        inner = {p for p, *_ in nodes.values()}
        best = []
        for i in nodes:
            if i in inner:
                continue
            path, at, seen = [], i, set()
            while at in nodes and at not in seen:
                seen.add(at)
                path.append(at)
                at = nodes[at][0]
            if at not in seen:
                best.append((-sum(nodes[k][3] for k in path), i, path[::-1]))
        if best:
            out[t] = [(nodes[k][1], nodes[k][2]) for k in min(best)[2]]
    return out


SCHEMA = "tree long, id long, parent long, role string, text string, score double"


def read(spark, messages):
    frame = spark.createDataFrame(messages, SCHEMA)
    written = chat.write_conversations(chat.best_paths(frame))
    rows = written.select("tree", "formatted", chat.read_turns(written.formatted).alias("turns"), chat.read_masked(written.formatted, written.loss_spans).alias("loss")).collect()
    return rows


def test_best_paths_of_random_trees_read_back(spark):
    rng = random.Random(4)
    bits = ["<|im_end|>", "<|im_start|>assistant", "\\", "\\|", "<\\|", "<", "|", ">", "\n", "é", "text ", "\\n", "😀"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    messages = []
    for t in range(25):
        n = rng.randrange(1, 40)
        for i in range(n):
            parent = None if i == 0 or rng.random() < 0.05 else rng.randrange(i)
            role = rng.choice(["user", "assistant", "assistant", "sys\ntem", "a\\n<|b", None])
            messages.append((t, i, parent, role, rng.choice([text(), None]), float(rng.randrange(1000)) / 8))
    messages += [(None, 1, None, "assistant", "tree without id", 0.0), (50, 1, 2, "user", "cycle", 0.0), (50, 2, 1, "user", "cycle", 0.0), (51, 3, 99, "user", "orphan", None)]
    messages += [messages[0]]
    rows = read(spark, messages)
    want = tree(messages)
    assert {r.tree: [tuple(x) for x in r.turns] for r in rows} == want
    assert {r.tree: r.loss for r in rows} == {t: "".join(x for role, x in p if role == "assistant") for t, p in want.items()}


def test_second_best_branch(spark):
    frame = spark.createDataFrame([(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "low", 1.0), (1, 3, 1, "assistant", "high", 2.0)], SCHEMA)
    got = {(r.path_rank, r.depth): r.text for r in chat.best_paths(frame, per_tree=2).collect()}
    assert got == {(1, 0): "q", (1, 1): "high", (2, 0): "q", (2, 1): "low"}


def test_chain_of_turns(spark):
    rows = [(1, 2, "assistant", "c", 9), (1, 0, "user", None, 9), (1, 0, "user", "a", 9), (2, None, None, "x", 9)] + [(3, i, "assistant", str(i), 9) for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, tree int")
    paths = chat.best_paths(chat.reply_chain(frame)).collect()
    turns = lambda t: [r.text for r in sorted((r for r in paths if r.tree == t), key=lambda r: r.depth)]
    assert turns(1) == ["", "a", "c"] and turns(2) == ["x"] and turns(3) == [str(i) for i in range(300)]
    assert chat.write_conversations(chat.best_paths(chat.reply_chain(frame.limit(0)))).count() == 0
