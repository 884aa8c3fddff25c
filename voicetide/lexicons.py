"""Default lexicons.

Brand names are arguments: the bot bucket gets one ``"<brand> ai"`` pattern
per brand under study.
"""

from __future__ import annotations

from collections.abc import Iterable

from voicetide.config import Bucket, Taxonomy

# Bucket patterns, labels and keyword lists.  Results depend on
# them and on the order inside a bucket, so they are kept exactly as they are.
CANCELLATION = (
    "cancell?ed", "cancell?ation", "auto.cancel", "order cancel",
    "restaurant cancel", "delivery cancel", "cancel order",
)
AI_BOT = (
    "bot loop", "chatbot", "ai support", "automated response",
    "no human", "reach human", "virtual assistant", "bot response",
    "automated", "ai agent",
)
CUSTOMER_CARE = (
    "customer (care|service|support|executive)", "agent behav",
    "rude (agent|executive|support)", "no (callback|response|resolution)",
    "slow support", "escalat", "poor support", "support team",
    "helpless", "useless support",
)
DELAY = (
    "late deliver", "delay(ed)?", "took (too )?long", "waiting",
    "hours? (for|to get)", "still waiting", "not delivered yet",
    "eta", "overdue", "delayed deliver",
)
FOOD_QUALITY = (
    "wrong (item|order|food)", "missing (item|food|order)",
    "cold food", "packaging", "spill(ed)?", "veg.non.veg",
    "non.?veg.*veg", "hair", "insect", "foreign (particle|object|material)",
    "stale", "taste", "undercooked", "overcooked", "quantity",
    "quality (issue|problem|bad)", "bad food", "not fresh",
    "spoiled", "rotten",
)
DELIVERY_EXECUTIVE = (
    "delivery (boy|guy|partner|executive|agent|person)",
    "rude (deliver|rider|partner)", "fake deliver", "didn.t deliver",
    "come outside", "safety (concern|issue)", "tamper",
    "unprofessional", "not delivering", "rider behav",
)
PAYMENT_COUPON = (
    "payment fail", "double (charge|debit)", "refund",
    "coupon (not applied|fail|issue)", "cashback", "wallet",
    "money deducted", "charged (twice|extra|again)", "not refunded",
    "promo (code|fail)", "discount not applied",
)
PRICE_FEE = (
    "platform fee", "delivery (fee|charge)", "surge (price|pricing|fee)",
    "high (price|fee|charge)", "hidden charge", "rain (fee|surcharge)",
    "extra fee", "overcharging", "price (hike|increase)",
)
NEGATIVE_WORDS = (
    "worst|terrible|horrible|awful|bad|poor|delay|cancel|refund|angry|"
    "frustrated|useless|cheated|scam|fraud|disgusting|pathetic|incompetent|"
    "disappointed|never (again|order|use)|waste|ruin|wrong|missing|cold|"
    "rude|unprofessional|tamper|fake|stale|overcharge|hidden|surge|"
    "no response|bot loop|chatbot|automated"
)
POSITIVE_WORDS = (
    "great|excellent|amazing|good|love|happy|satisfied|fast|quick|"
    "on time|perfect|wonderful|appreciate|thank"
)
COMPLAINT_WORDS = (
    "complaint|issue|problem|cancel|delay|refund|wrong|missing|rude|"
    "tamper|fraud|scam|overcharge|not working|failed|not delivered|"
    "poor|bad|terrible|worst|useless|angry|frustrated|disappointed"
)
ESCALATION_WORDS = (
    "escalat|consumer court|legal|police|ncpr|twitter|social media|"
    "going viral|complaint box|grievance|ombudsman|filing complaint|"
    "taking action|no resolution|nobody helping|days? (later|ago) still"
)
RESCUE_WORDS = ("food", "delivery", "order")
# End of fixed values.


def default_taxonomy(brands: Iterable[str] = ()) -> Taxonomy:
    """The nine-bucket taxonomy for the given brands."""
    bot = AI_BOT + tuple(f"{b.lower()} ai" for b in brands)
    return Taxonomy(
        buckets=(
            Bucket("A_Cancellation", "A. Cancellation", CANCELLATION),
            Bucket("B_AI_Bot", "B. AI/Bot Related", bot),
            Bucket("C_Customer_Care", "C. Customer Care", CUSTOMER_CARE),
            Bucket("D_Delay", "D. Delay Related", DELAY),
            Bucket("E_Food_Quality", "E. Food Quality", FOOD_QUALITY),
            Bucket("F_Delivery_Executive", "F. Delivery Executive", DELIVERY_EXECUTIVE),
            Bucket("G_Payment_Coupon", "G. Payment/Coupon", PAYMENT_COUPON),
            Bucket("H_Price_Fee", "H. Price/Fee", PRICE_FEE),
        ),
        default=Bucket("I_Other", "I. Other/Emerging"),
    )
