"""Parameters of the named queries (shared by the Spark plans and the SQL
oracles): the reference's documented configuration."""

MAX_FEATURES = 20000
MIN_DF = 2
NGRAM_RANGE = (1, 2)
N_TOPICS = 10
N_TOP_TERMS = 15
N_ITER = 20
TOP_K_OVERVIEW = 10
MIN_TOKEN_LEN_QUERY = 2
# Appended to every text by the contraction queries (the corpora have none).
CONTRACTION_SUFFIX_TEXT = (" We can't stop, it's what they're gonna do; I'm sure you'd say "
                           "we'll see, he said 'damn' it and 'my bank' was 'really' 'very' slow, and they've won't-be gonna gonna wanna. "
                           "It's been paid, she's gone, he’d left, he'd go; the bank's fee, the bank's never been open, "
                           "'tis late, 'twas u, idk. I'd already called, she'd need it, who's there")
# What the contraction queries must make of it.
CONTRACTION_RESULT = (" we cannot stop, it is what they are going to do; i am sure you would say "
                      "we will see, he said 'damn' it and 'my bank' was 'really' 'very' slow, "
                      "and they have will not-be going to going to want to. "
                      "it has been paid, she has gone, he had left, he would go; the bank's fee, the bank has never been open, "
                      "it is late, it was you, i do not know. i had already called, she would need it, who is there")
# Appended to every token list by the lemma query, with the lemmas it must give.
LEMMA_CASES = {
    "opened": "open", "reported": "report", "removed": "remove", "running": "run",
    "calling": "call", "agreed": "agree", "stopped": "stop", "buses": "bus",
    "told": "tell", "charged": "charge", "disputes": "dispute", "denied": "deny",
    "applied": "apply", "closed": "close", "stated": "state", "required": "require",
    "providing": "provide", "settled": "settle", "using": "use", "thing": "thing",
    "during": "during", "needed": "need", "cancelled": "cancel", "companies": "company",
    "dealt": "deal", "slept": "sleep", "swept": "sweep", "hung": "hang", "tore": "tear", "swam": "swim",
    "bitten": "bite", "withheld": "withhold", "overdrawn": "overdraw", "underwritten": "underwrite", "repaid": "repay",
    "phenomena": "phenomenon", "hypotheses": "hypothesis", "criteria": "criterion", "salesmen": "salesman",
    "ground": "ground", "thieves": "thief",
}
# Sentences that the context lemma query puts behind every text by turns, with their lemmas.
CONTEXT_CASES = {
    "he left the bank": "he leave the bank", "the left side is dark": "the left side be dark",
    "they saw it": "they see it", "the saw is sharp": "the saw be sharp",
    "we are building a house": "we be build a house", "the building is old": "the building be old",
    "she leaves the office": "she leave the office", "the leaves are green": "the leaf be green",
    "we found an error": "we find an error", "she wants to found a company": "she want to found a company",
    "the meeting with my banker": "the meeting with my banker", "they were meeting us": "they be meet us",
    "i have left the firm": "i have leave the firm", "their lives are short": "their life be short",
    "he lives in town": "he live in town", "the ground is wet": "the ground be wet",
    "the left building is mine": "the left building be mine", "they found saving the files hard": "they find save the file hard",
}
# A user's vocabulary: terms at given columns, one of them in no text.
USER_VOCABULARY = {"the": 3, "and the": 0, "der": 4, "la": 1, "que la": 5, "no such term": 2, "in": 6}
